"""Fill-in-middle, cross-tokenizer alignment and license scans against plain versions."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from lodeframe.llm import fill_middle as fim
from lodeframe.llm import licenses, queries, token_alignment

A_FILE, B_FILE = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
UNITS = {"line": re.compile(r"[^\n]*\n|[^\n]+"), "word": re.compile(r"[ \t-\r]*[^ \t-\r]+|[ \t-\r]+"), "char": re.compile(r"(?s).")}

NOTICE = "This work is licensed under the GNU General Public License, version 3."
ODD = [
    None,
    "",
    " ",
    "\n",
    "\n\n a",
    "no newline",
    "a\r\nb\x0bc d\x85e\n",
    "has <P> inside",
    "ends with <",
    "P> starts, <M",
    "S><M",
    "é😀 　 x\n\n\n",
    "<s> </s> <unk> <0x41> <|endoftext|> <pad>",
    "a ▁ b",
    "\t tabs\t\t and   spaces   ",
    "x\x00y",
    "﻿mark of byte order",
    "نص عربي 漢字かな交じり文 क्षि ไทย",
    "=" * 300 + "-" * 77 + " " * 50 + "\n" * 9,
    "ab" * 4000,
    NOTICE,
    "Licensed under CC BY-NC 4.0. All Rights RESERVED!",
    "cc by cc-by CC_BY general public license general public license",
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this very software and associated documentation",
    "line of words\n" * 3000,
]
FILLER = "the of and work is licensed under version 3 license public general copy software a this free cc by rights all reserved granted sub".split()


def odd_texts():
    rng = random.Random(5)
    words = ["the ", "of\n", "né", "😀", " ", "Wort", "\n", "x1", "<P>", "…", "'s ", "12345", "\t", "ß"]
    return ODD + ["".join(rng.choices(words, k=rng.randrange(40))) for _ in range(60)] + ODD[5:9]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    at = str(tmp_path_factory.mktemp("units"))
    rows = [(k, t, "xx", "text", 1) for k, t in enumerate(odd_texts())] + [(None, "no id\nat all", "xx", "text", 1), (3, "again", "xx", "text", 1)]
    spark.createDataFrame(rows, "doc_id long, text string, place string, chunk string, n int").repartition(3).write.parquet(f"{at}/documents.parquet")
    return at


@pytest.fixture(scope="module")
def empty(spark, tmp_path_factory):
    at = str(tmp_path_factory.mktemp("empty"))
    spark.createDataFrame([], "doc_id long, text string").write.parquet(f"{at}/documents.parquet")
    return at


def texts_of(spark, folder):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_fim(doc_id, text, unit="line", spm=50, marks=("<P>", "<S>", "<M>")):
    units = UNITS[unit].findall(text or "")
    h = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[k : k + 8], 16) for k in (0, 8, 16, 24))
    if not text or any(m in text for m in marks):
        return len(units), "plain", None, None, text or ""
    a, b = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    p, s, m = marks
    if h4 % 100 < spm:
        return len(units), "spm", len(prefix), len(middle), s + suffix + p + prefix + m + middle
    return len(units), "psm", len(prefix), len(middle), p + prefix + s + suffix + m + middle


@pytest.mark.parametrize("unit", ["line", "word", "char"])
def test_units_are_cut_and_rearranged(spark, folder, unit):
    marks = ("<P>", "<S>", "<M>") if unit == "line" else ("<PRE>", "<SUF>", "<MID>")
    done = fim.fill_middle(spark.read.parquet(f"{folder}/documents.parquet"), unit, spm_percent=30, sentinels=fim.Sentinels(*marks))
    out = done.withColumn("back", fim.restored("output", "form", fim.Sentinels(*marks))).collect()
    expected = Counter((i, *plain_fim(i, t, unit, 30, marks), t or "") for i, t in texts_of(spark, folder))
    assert Counter(tuple(r) for r in out) == expected
    assert {r.form for r in out} == {"plain", "psm", "spm"}


def test_op11_contract(spark, folder, empty):
    out = queries.op11_fill_middle(spark, folder).collect()
    expected = Counter()
    for i, t in texts_of(spark, folder):
        n, form, a, b, output = plain_fim(i, t)
        expected[i, n, form, a, b, sha(output), sha(t or "")] += 1
    assert Counter(tuple(r) for r in out) == expected
    assert queries.op11_fill_middle(spark, empty).count() == 0


def test_shares_and_sentinels(spark):
    docs = spark.range(2000).selectExpr("id as doc_id", "concat('a\n', id, '\nb') as text")
    forms = Counter(r.form for r in fim.fill_middle(docs, fim_percent=40, spm_percent=25).collect())
    assert abs(forms["plain"] - 1200) < 90 and abs(forms["spm"] - 200) < 60
    for marks in (("<P>", "<P>", "<M>"), ("", "<S>", "<M>"), ("aba", "x", "y"), ("<P>", "<P>>", "<M>"), ("<a", "a<", "c")):
        with pytest.raises(ValueError, match="sentinels"):
            fim.Sentinels(*marks)
    with pytest.raises(ValueError, match="unit"):
        fim.fill_middle(docs, "page")


# --- alignment --------------------------------------------------------------------------------------------------


class Plain:
    """Both libraries, and alignment token by token."""

    def __init__(self):
        self.a = Tokenizer.from_file(A_FILE)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=B_FILE)
        alphabet = token_alignment.byte_alphabet()
        self.a_bytes = {i: bytes(alphabet[c] for c in p) for p, i in self.a.get_vocab().items() if i != 50256}

    def b_bytes(self, i):
        p = self.b.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()

    def groups(self, text):
        if not text:
            return []
        a, b = self.a.encode(" " + text, add_special_tokens=False).ids, self.b.encode(text)
        data = (" " + text).encode()
        if b"".join(map(self.a_bytes.get, a)) != data or b"".join(map(self.b_bytes, b)) != data:
            return []
        ends = []
        for ids, width in ((a, self.a_bytes.get), (b, self.b_bytes)):
            at, own = 0, []
            for i in ids:
                at += len(width(i))
                own.append((at, i))
            ends.append(own)
        shared = sorted({e for e, _ in ends[0]} & {e for e, _ in ends[1]})
        out = [([], []) for _ in shared]
        for side in (0, 1):
            for end, i in ends[side]:
                out[next(k for k, e in enumerate(shared) if e >= end) if len(shared) < 200 else int(np.searchsorted(shared, end))][side].append(i)
        return out

    def corpus(self, texts):
        held = [self.groups(t) for t in texts]
        count = Counter()
        for groups in held:
            count.update({(a, b) for x, y in groups for a in x for b in y})
        top = defaultdict(int)
        for (a, _), n in count.items():
            top[a] = max(top[a], n)
        for groups in held:
            links = [(a, b) for x, y in groups for a in x for b in y]
            written = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
            yield (
                sum(len(x) for x, _ in groups), sum(len(y) for _, y in groups), len(groups), len(links),
                sum(count[p] == top[p[0]] for p in links), sum(count[p] for p in links), sha(written) if groups else "",
            )


@pytest.fixture(scope="module")
def plain():
    return Plain()


def test_op12_contract(spark, folder, empty, plain):
    rows = texts_of(spark, folder)
    expected = Counter((i, *r) for (i, _), r in zip(rows, plain.corpus([t for _, t in rows]), strict=True))
    columns = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert Counter(tuple(r) for r in queries.op12_token_alignment(spark, folder).select(columns).collect()) == expected
    # chunks change nothing
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    small = token_alignment.align_documents(docs, A_FILE, B_FILE, public_tokenizers.PATTERN, chunk_bytes=300)
    assert Counter(tuple(r) for r in small.select(columns).collect()) == expected
    assert queries.op12_token_alignment(spark, empty).count() == 0


def aligner():
    with open(A_FILE) as a, open(B_FILE, "rb") as b:
        return token_alignment.Aligner(a.read(), b.read(), public_tokenizers.PATTERN)


def test_encoders_equal_the_libraries_at_every_code_point(plain):
    own = aligner()
    points = [c for c in range(1, 0x110000) if not 0xD800 <= c < 0xE000 and c != 0x2581]
    texts = ["".join(f"{chr(c)}a {chr(c)}" for c in points[k : k + 4000]) for k in range(0, len(points), 4000)]
    for text, a in zip(texts, plain.a.encode_batch([" " + t for t in texts], add_special_tokens=False), strict=True):
        assert own.a.encode(" " + text).tolist() == a.ids
        assert own.b.encode(text).tolist() == plain.b.encode(text)
    rng = random.Random(9)
    for _ in range(500):
        text = "".join(rng.choices([" ", "\n", "a", "der", "_", "  ", "\r", ").", "é", "𝄞", "\t"], k=rng.randrange(1, 30)))
        assert own.b.encode(text).tolist() == plain.b.encode(text)


def test_large_groups_pair_distinct_ids(monkeypatch):
    own = aligner()
    texts = [t for t in odd_texts() if t] + ["漢字" * 50, "ab" * 500]
    expected = own.align(texts)
    monkeypatch.setattr(token_alignment, "LARGE_GROUP", 1)
    found = own.align(texts)
    assert found[0] == expected[0]
    for (p, n), (q, m) in zip(found[1], expected[1], strict=True):
        assert (p == q).all() and (n == m).all()


def test_overlaps_and_cuts_of_owners():
    rng = random.Random(2)
    for _ in range(50):
        size = rng.randrange(1, 60)
        sides = []
        for _ in "ab":
            cuts = sorted({*rng.sample(range(1, size), rng.randrange(size)), size}) if size > 1 else [1]
            sides.append(np.diff(cuts, prepend=0))
        both = token_alignment.Alignment(*sides)
        spans = [[(int(e - n), int(e)) for e, n in zip(np.cumsum(s), s, strict=True)] for s in sides]
        overlaps = {(i, j) for i, x in enumerate(spans[0]) for j, y in enumerate(spans[1]) if x[0] < y[1] and y[0] < x[1]}
        assert set(zip(*(x.tolist() for x in both.overlaps()), strict=True)) == overlaps
        ends = sorted({e for _, e in spans[0]} & {e for _, e in spans[1]})
        group = lambda span: next(k for k, e in enumerate(ends) if span[1] <= e)
        links = {(i, j) for i, x in enumerate(spans[0]) for j, y in enumerate(spans[1]) if group(x) == group(y)}
        assert set(zip(*(x.tolist() for x in both.links()), strict=True)) == links >= overlaps


# --- licenses ---------------------------------------------------------------------------------------------------


def brute_words(text):
    return [w.encode() for w in licenses.WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))]


def brute_matches(words, templates, shortest):
    out = set()
    for k, text in enumerate(templates):
        for i in range(len(words)):
            for j in range(len(text)):
                if i and j and words[i - 1] == text[j - 1]:
                    continue
                n = 0
                while i + n < len(words) and j + n < len(text) and words[i + n] == text[j + n]:
                    n += 1
                if n >= shortest:
                    out.add(licenses.Match(i, n, k, j))
    return out


def brute_cover(matches, gap):
    """Most words that a chain of one template's matches covers."""
    best = {}
    for m in sorted(matches):
        best[m] = m.length
        for p in best:
            apart, there = m.start - p.start - p.length, m.at - p.at - p.length
            if p.start < m.start and p.at < m.at and apart <= gap and there <= gap and m.length + min(apart, there, 0) > 0:
                best[m] = max(best[m], best[p] + m.length + min(apart, there, 0))
    return max(best.values(), default=0)


def test_matches_are_all_maximal_ones():
    rng = random.Random(4)
    for shortest in (1, 2, 3):
        for _ in range(60):
            templates = [("t", " ".join(rng.choices("abc", k=rng.randrange(1, 14)))) for _ in range(rng.randrange(1, 5))]
            phrases = [(" ".join(rng.choices("abcd", k=rng.randrange(1, 4))), "p") for _ in range(3)]
            own = licenses.Automaton(templates, phrases)
            words = brute_words(" ".join(rng.choices("aabcd", k=rng.randrange(40))))
            found, matches = own.scan(words, shortest)
            assert len(matches) == len(set(matches))
            assert set(matches) == brute_matches(words, [brute_words(t) for _, t in templates], shortest)
            places = [(i, k) for k, (t, _) in enumerate(phrases) for i in range(len(words)) if words[i : i + len(t.split())] == brute_words(t)]
            assert sorted(found) == sorted(places)
            spans = own.chains(matches, 2)
            for k in range(len(templates)):
                mine = [s.covered for s in spans if s.template == k]
                assert max(mine, default=0) == brute_cover([m for m in matches if m.template == k], 2)


def test_op13_contract(spark, empty, tmp_path):
    rng = random.Random(8)
    templates = [t for _, t in licenses.TEMPLATES]
    texts = odd_texts() + [" ".join(rng.choices(FILLER, k=50)) + rng.choice(["", ". " + rng.choice(templates)]) + " ".join(rng.choices(FILLER, k=9)) for _ in range(60)]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    out = {r.doc_id: r for r in queries.op13_license_scan(spark, str(tmp_path)).collect()}
    assert len(out) == len(texts)
    for i, text in enumerate(texts):
        words, r = brute_words(text), out[i]
        places = [(k, label) for phrase, label in licenses.PHRASES for k in range(len(words)) if words[k : k + len(phrase.split())] == brute_words(phrase)]
        assert (r.n_words, r.n_base) == (len(words), len(places))
        assert (r.first_word, r.last_word) == ((min(places)[0], max(places)[0]) if places else (None, None))
        base = {label for _, label in places}
        assert r.base_labels == ",".join(sorted(base))
        assert base <= set(filter(None, r.labels.split(",")))
        if len(words) < 2000:
            held = brute_matches(words, [brute_words(t) for t in templates], licenses.SHORTEST)
            shares = [brute_cover([m for m in held if m.template == k], licenses.GAP) / len(brute_words(t)) for k, t in enumerate(templates)]
            assert r.score == pytest.approx(max(shares))
            assert (max(shares) >= licenses.COVER) == any(label in r.labels.split(",") for label, _ in licenses.TEMPLATES if label not in base)
    assert queries.op13_license_scan(spark, empty).count() == 0


def test_spans_of_a_license_inside_a_text(spark):
    text = "intro words here. " + NOTICE + " then more. Licensed under CC BY-NC 4.0. " + templates_text("mit", 2).replace("free of charge", "wholly free of charge") + " end"
    docs = spark.createDataFrame([("a", text), ("b", None)], "doc_id string, text string")
    rows = {r.doc_id: r for r in licenses.scan_licenses(docs).collect()}
    spans = [(s.label, s.start, s.covered) for s in rows["a"].spans]
    assert spans[:2] == [("gpl-3.0", 3, 12), ("cc-by-nc-4.0", 17, 7)]
    assert rows["a"].labels == "cc-by,cc-by-nc-4.0,gpl,gpl-3.0,mit"
    assert (rows["b"].n_words, rows["b"].labels, rows["b"].score, rows["b"].spans) == (0, "", 0.0, [])


def templates_text(label, which):
    return [t for name, t in licenses.TEMPLATES if name == label][which]


def test_template_bounds():
    with pytest.raises(ValueError, match="hold words"):
        licenses.Automaton([("a", "...")])
    with pytest.raises(ValueError, match="more than"):
        licenses.Automaton([("a", "x " * (licenses.MOST_TOKENS + 1))])
