"""Fill-in-middle transformation: texts are cut at two unit borders and rearranged around sentinels.

One Aho-Corasick automaton holds the ASCII characters at which the class of a
character changes for the unit asked, and the sentinels.  One pass over a text
reports where they are; of the gaps between these events the units follow by
arithmetic (``Units``), so the border of any unit is a lookup of its rank among
few events, and no text is split into its units:

* ``line``: up to and with a newline, the last one without where none ends the text;
* ``word``: white space (space, and 9 to 13) and the other characters after it, white space at the end by itself;
* ``char``: a code point; it has no events, ranks are offsets.

Two draws of a document decide the borders, a third whether it stays plain, a
fourth which form it takes:

* ``plain``: the text;
* ``psm``: ``<P>`` prefix ``<S>`` suffix ``<M>`` middle;
* ``spm``: ``<S>`` suffix ``<P>`` prefix ``<M>`` middle.

Defined cases: a null text is an empty one; an empty text, and one that holds a
sentinel, stays plain; a row without an id draws as the empty id does; rows that
repeat an id draw alike; texts of any length are read whole; extra columns are
ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .storage import text_batches

#: The characters that end a class, by unit.
WHITE = " \t\n\v\f\r"
BREAKS = {"line": "\n", "word": WHITE, "char": ""}


@dataclass(frozen=True)
class Sentinels:
    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"

    def __post_init__(self) -> None:
        marks = self.all
        if len(set(marks)) < 3 or not all(marks):
            raise ValueError("sentinels must be three different strings")
        # so that no sentinel can arise where a part of a text meets another sentinel, or inside one
        for a in marks:
            for b in marks:
                if (a != b and a in b) or any(a.endswith(b[:k]) for k in range(1, len(b))):
                    raise ValueError(f"sentinels overlap: {a!r}, {b!r}")

    @property
    def all(self) -> tuple[str, str, str]:
        return self.prefix, self.suffix, self.middle


class Units:
    """The units of one text, known by the events of one pass."""

    def __init__(self, unit: str, length: int, events: np.ndarray):
        self.length = length
        if unit == "char":
            self.ends, self.count = None, length
            return
        if unit == "line":
            ends = events + 1
        else:
            # a gap between two white characters is one word: it ends where the gap does
            before = np.concatenate([[-1], events])
            after = np.append(events, length)
            ends = after[after - before > 1]
        if length and (not len(ends) or ends[-1] < length):
            ends = np.append(ends, length)
        self.ends, self.count = ends, len(ends)

    def border(self, rank: int) -> int:
        """Where the first ``rank`` units end."""
        if rank <= 0:
            return 0
        return int(self.ends[rank - 1]) if self.ends is not None else rank


class Scanner:
    """The automaton of one unit and its sentinels."""

    def __init__(self, unit: str, sentinels: Sentinels):
        if unit not in BREAKS:
            raise ValueError(f"unit must be one of {', '.join(BREAKS)}")
        self.unit = unit
        self.automaton = ahocorasick.Automaton()
        for c in BREAKS[unit]:
            self.automaton.add_word(c, 1)
        for mark in sentinels.all:
            self.automaton.add_word(mark, 0)
        self.automaton.make_automaton()

    def scan(self, text: str) -> tuple[Units, bool]:
        """The text's units, and whether it holds a sentinel."""
        # eight bytes an event, however many a text has
        found = np.fromiter((at << 1 | kind for at, kind in self.automaton.iter(text)), np.int64)
        events = found[found & 1 == 1] >> 1
        return Units(self.unit, len(text), events), len(events) < len(found)


def draws(doc_id: object, seed: str) -> list[int]:
    """Four numbers below 2 ** 32: the first digits of the hash of seed and id."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[k : k + 8], 16) for k in (0, 8, 16, 24)]


def fill_middle(
    docs: DataFrame, unit: str = "line", seed: str = "7", fim_percent: int = 100, spm_percent: int = 50, sentinels: Sentinels | None = None
) -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars, output`` of every row of ``docs(doc_id, text)``.

    ``n`` counts the text's units.  ``fim_percent`` of the documents are
    rearranged, ``spm_percent`` of these with the suffix first.  The counts of
    code points are null where the form is plain.
    """
    marks = sentinels or Sentinels()
    Scanner(unit, marks)  # refuses unknown units on the driver
    text_batches(docs.sparkSession)
    id_type = dict(docs.dtypes)["doc_id"]

    def rearranged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(unit, marks)
        for batch in batches:
            rows = []
            for doc_id, value in zip(batch["doc_id"].to_pylist(), batch["text"], strict=True):
                text = value.as_py() or ""
                units, marked = scanner.scan(text)
                first, second, third, fourth = draws(doc_id, seed)
                if not text or marked or third % 100 >= fim_percent:
                    rows.append((units.count, "plain", None, None, text))
                    continue
                low, high = sorted((first % (units.count + 1), second % (units.count + 1)))
                a, b = units.border(low), units.border(high)
                prefix, middle, suffix = text[:a], text[a:b], text[b:]
                if fourth % 100 < spm_percent:
                    form, parts = "spm", (marks.suffix, suffix, marks.prefix, prefix, marks.middle, middle)
                else:
                    form, parts = "psm", (marks.prefix, prefix, marks.suffix, suffix, marks.middle, middle)
                rows.append((units.count, form, a, b - a, "".join(parts)))
            n, form, a, b, output = zip(*rows, strict=True) if rows else ((),) * 5
            columns = [batch["doc_id"], pa.array(n, pa.int64()), pa.array(form, pa.string()), pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(output, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    schema = f"doc_id {id_type}, n long, form string, prefix_chars long, middle_chars long, output string"
    return docs.select("doc_id", "text").mapInArrow(rearranged, schema)


def restored(output: Column | str, form: Column | str, sentinels: Sentinels | None = None) -> Column:
    """The text that ``fill_middle`` rearranged, from its output and form alone.

    Each sentinel stands once in a rearranged text, so its parts lie between them.
    """
    marks = sentinels or Sentinels()
    out, form = F.col(output) if isinstance(output, str) else output, F.col(form) if isinstance(form, str) else form
    head, middle = F.substring_index(out, marks.middle, 1), F.substring_index(out, marks.middle, -1)
    prefix_of = {"psm": F.substring_index(F.substring_index(head, marks.suffix, 1), marks.prefix, -1), "spm": F.substring_index(head, marks.prefix, -1)}
    suffix_of = {"psm": F.substring_index(head, marks.suffix, -1), "spm": F.substring_index(F.substring_index(head, marks.prefix, 1), marks.suffix, -1)}
    whole = {kind: F.concat(prefix_of[kind], middle, suffix_of[kind]) for kind in prefix_of}
    return F.when(form == "psm", whole["psm"]).when(form == "spm", whole["spm"]).otherwise(out)
