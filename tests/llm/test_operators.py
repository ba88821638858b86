"""Each operator against a brute-force version, and its defined cases."""

import base64
import hashlib
import random
import zlib
from array import array
from collections import Counter
from itertools import combinations

import corpus_pipeline
import numpy as np
import public_tokenizers
import pytest
import tiktoken

from lodeframe.llm import byte_bpe, chat_format, components, html_extract, media_columns, mixing, ngram_join, queries, spotsigs, substring_dedup, toxicity, url_filter, webp, windows
from pyspark.sql import functions as F

DOCS = "doc_id long, text string, source string, size string"


def frame(spark, rows, schema=DOCS):
    return spark.createDataFrame(rows, schema)


def odd_rows():
    """Null, empty, repeated, tied and long rows, with a column named like a result."""
    long = " ".join(f"w{k % 997}" for k in range(30_000))
    return [
        (1, None, "a", "x"),
        (2, "", None, "x"),
        (3, "One two", "a", None),
        (3, "One two", "a", None),
        (4, long, "b", "x"),
        (None, "no id here", "b", "x"),
        (5, " \t\n ", "b", "x"),
    ]


# --- toxicity ---------------------------------------------------------------------------------------------------


def toy_labels(n=300):
    rng = random.Random(5)
    words = [a + b for a in ("ba", "lo", "mi", "tu", "re") for b in ("na", "ko", "sil", "ter", "vo")]
    rows = []
    for k in range(n):
        text = [rng.choice(words) for _ in range(30)]
        toxic = k % 3 == 0
        if toxic:
            text[rng.randrange(20)] = rng.choice(["moronly", "moronish", "scumbag"])
            if rng.random() < 0.7:
                text[rng.randrange(20, 30)] = "muslim"
        elif rng.random() < 0.1:
            text[rng.randrange(30)] = "christian"
        rows.append((k, " ".join(text) + ".", int(toxic)))
    return rows


def test_toxicity_is_learnt_and_neutral_mentions_are_not_punished():
    rows = toy_labels()
    texts, labels = [r[1] for r in rows], [r[2] for r in rows]
    fitted = lambda lam: toxicity.Scorer(toxicity.fit(texts, labels, lam, 2e-5, 3, toxicity.IDENTITY_SETS))
    with_pairs, without = fitted(5.0), fitted(0.0)
    scores = [with_pairs(t) for t in texts]
    assert min(s for s, y in zip(scores, labels, strict=True) if y) >= 0.7
    assert max(s for s, y in zip(scores, labels, strict=True) if not y) < 0.7
    mention = "the muslim bana lokor visited the tuna."
    assert with_pairs(mention) < without(mention)
    assert abs(with_pairs(mention) - with_pairs(mention.replace("muslim", "christian"))) < 0.05
    assert with_pairs("") == with_pairs(None)


def test_no_long_text_takes_the_pairs_of_others():
    # the first text swaps one set far more than 5,000 times; the second set is named later only
    rows = toy_labels()
    rows = [(k, t.replace("muslim", "frau"), y) for k, t, y in rows]
    long = "black lokor and white bana. " * 1000
    texts, labels = [long] + [r[1] for r in rows], [0] + [r[2] for r in rows]
    fitted = lambda lam: toxicity.Scorer(toxicity.fit(texts, labels, lam, 2e-5, 3, toxicity.IDENTITY_SETS))
    punished, fair = fitted(0.0), fitted(5.0)
    mention = "the frau bana lokor visited the tuna."
    assert fair(mention) < punished(mention)
    assert abs(fair(mention) - fair(mention.replace("frau", "mann"))) < 0.05


def test_telling_sentences_leave_none_out():
    text = "a bad day. " * 6 + "a bad worse ugly end."
    found = list(toxicity.telling_sentences(text, {"bad", "worse", "ugly"}))
    assert sum(w == {"a", "bad", "day"} for w, _ in found) == 6 and {"worse"} in [w for w, _ in found] and {"ugly"} in [w for w, _ in found]
    assert sum(share for w, share in found if len(w) > 1) == pytest.approx(4)


def test_toxicity_cases(spark):
    docs = frame(spark, odd_rows())
    labels = spark.createDataFrame([(3, None), (1, 0), (99, 1), (None, 1)], "doc_id long, toxic int")
    model = toxicity.train(docs, labels)
    assert model["weights"] == {} and 0 <= toxicity.Scorer(model)("x") <= 0.01
    score = toxicity.score_column(spark, model)
    assert docs.select(score(F.col("text"))).count() == 7
    assert docs.limit(0).select(score(F.col("text")).alias("s")).collect() == []


@pytest.mark.parametrize("case", ["no labels", "no documents", "other ids"])
def test_toxicity_on_empty_tables(spark, tmp_path, case):
    rows = toy_labels(40)
    docs = [] if case == "no documents" else [(k, t) for k, t, _ in rows]
    labels = [] if case == "no labels" else [(k + 10_000 * (case == "other ids"), y) for k, _, y in rows]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    out = queries.op1_toxicity(spark, str(tmp_path)).collect()
    assert len(out) == len(docs) and all(r.score < 0.01 and r.predicted == 0 for r in out)
    table = spark.read.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.drop_toxic(spark, table, str(tmp_path)).count() == len(docs)


def test_repeated_and_unreadable_labels_take_no_places(spark):
    rows = toy_labels(120)
    docs = spark.createDataFrame([(k, t) for k, t, _ in rows], "doc_id long, text string")
    plain = [(k, y) for k, _, y in rows]
    expected = toxicity.train(docs, spark.createDataFrame(plain, "doc_id long, toxic int"), sample=40)
    assert expected["weights"]
    repeated = [r for r in plain for _ in range(50 if r[0] < 4 else 1)] + [(k + 5000, k % 2) for k in range(300)] + [(9000 + k, k % 2) for k in range(100)]
    long = spark.createDataFrame([(9000 + k, "word " * 50_000) for k in range(100)], docs.schema)
    assert toxicity.train(docs.union(docs.where("doc_id < 9")).union(long), spark.createDataFrame(repeated, "doc_id long, toxic int"), sample=40) == expected


def test_toxicity_trains_in_spark(spark):
    rows = toy_labels()
    docs = spark.createDataFrame([(k, t) for k, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(k, y) for k, _, y in rows], "doc_id long, toxic int")
    model = toxicity.train(docs, labels, sample=80)
    score = toxicity.score_column(spark, model)
    got = {r[0]: r[1] for r in docs.select("doc_id", score(F.col("text"))).collect()}
    assert sum((got[k] >= 0.7) == bool(y) for k, _, y in rows) >= 295


# --- chat formatting --------------------------------------------------------------------------------------------


def chat_rows():
    rng = random.Random(1)
    parts = ["<|im_end|>\n", "<|im_start|>assistant\n", "\\", "|", "<", "<|", "\\|", "<\\|", "é", "😀", "\ufeff", "\ufffe", "\n", "", "<|im_sep|>", "$1"]
    rows = [(1, k, rng.choice(["user", "assistant", "sys\ntem|<|", ""]), "".join(rng.choices(parts, k=rng.randrange(8)))) for k in range(60)]
    rows += [(2, 0, None, None), (2, 0, None, None), (3, None, "assistant", "x" * 100_000), (None, 1, "user", "y")]
    rows += [(4, k, rng.choice(["user", "assistant"]), rng.choice(["", "\ufeff", "\ufeffa"]) + "z" * rng.randrange(4)) for k in range(700)]
    return rows


def test_chat_round_trip(spark):
    rows = chat_rows()
    turns = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").withColumn("formatted", F.lit("clash"))
    done = chat_format.format_conversations(turns)
    got = done.select("conv_id", chat_format.read_turns(F.col("formatted")).alias("t"), chat_format.masked_text(F.col("formatted"), F.col("loss_spans")).alias("m"), "formatted", "loss_spans").collect()
    assert len(got) == 5
    for r in got:
        own = sorted(((x[1] if x[1] is not None else -1), x[2] or "", x[3] or "") for x in rows if x[0] == r.conv_id)
        assert [(t.role, t.text) for t in r.t] == [(a, b) for _, a, b in own]
        assert r.m == "".join(t for _, a, t in own if a == "assistant")
        assert r.formatted.count("<|im_end|>\n") == 1 + sum(a[1] != b[1] for a, b in zip(own, own[1:], strict=False))
    assert chat_format.format_conversations(turns.limit(0)).collect() == []
    lost = spark.createDataFrame([(None, k, "user", f"t{k}") for k in range(9)], turns.drop("formatted").schema)
    assert chat_format.format_conversations(lost).count() == 9


def test_running_sums(spark):
    for n in (0, 1, 63, 64, 65, 1000):
        numbers = [random.Random(n).randrange(50) for _ in range(n)]
        frame_ = spark.createDataFrame([(numbers,)], "n array<bigint>")
        assert frame_.select(chat_format.running_sums(F.col("n"))).first()[0] == [sum(numbers[:k]) for k in range(n)]


# --- URL filters ------------------------------------------------------------------------------------------------


def brute_rule(host, path, rules):
    best = None
    for rule, verdict in rules:
        h, _, p = rule.partition("/")
        p = "/" + p if "/" in rule else ""
        if (host == h or host.endswith("." + h)) and path.startswith(p):
            key = (len(rule), len(h), verdict == "block")
            if best is None or key > best[0]:
                best = (key, rule, verdict)
    return best and best[1:]


@pytest.mark.parametrize("small", [1000, 0])
def test_url_rules(spark, small):
    rng = random.Random(2)
    hosts = ["com", "a.com", "b.a.com", "com-x", "net", "a.net", "x.y.z.net", "acom"]
    rules = sorted({(f"{rng.choice(hosts)}/{rng.choice(['', 'en/', 'en/7', 'de/', 'de/8/x'])}", rng.choice(["allow", "block"])) for _ in range(30)})
    rules = list(dict(rules).items())
    urls = [(k, f"http://{rng.choice(hosts).upper()}/{rng.choice(['en/7', 'en', 'de/8/x?q=1', '#f', 'en/71/'])}") for k in range(300)]
    urls += [(900, None), (901, "nothing"), (902, "x://"), (903, "a://b://c"), (904, "u://a.com?x/en/"), (905, "u://a.com"), (905, "u://a.com")]
    frame_ = spark.createDataFrame(urls, "page_id long, url string").withColumn("rule", F.lit("clash"))
    out = url_filter.judge_urls(frame_, spark.createDataFrame([*rules, (None, "block")], "rule string, verdict string"), small_rules=small).collect()
    assert len(out) == len(urls)
    for r in out:
        want = brute_rule(r.host, r.path, rules)
        assert (r.rule, r.verdict) == (want or (None, "allow")), r
    by = {r.page_id: (r.host, r.path) for r in out}
    assert by[900] == by[901] == by[902] == ("", "") and by[903] == ("b:", "//c") and by[904] == ("a.com", "") and by[905] == ("a.com", "")


# --- mixing -----------------------------------------------------------------------------------------------------


def test_targets_are_the_reshared_fixed_point(spark):
    sizes = {"a": 10, "b": 1000, "c": 500, None: 3, "d": 0}
    rows = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r.source: r.target for r in mixing.source_targets(rows).collect()}
    order = ["a", "b", "c", "d", None]
    weight = {s: k % 3 + 1 for k, s in enumerate(order)}
    target, capped, total = {}, set(), sum(sizes.values())
    while True:
        left = total - sum(3 * sizes[s] for s in capped)
        open_ = [s for s in order if s not in capped]
        target = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_} | {s: 3.0 * sizes[s] for s in capped}
        over = {s for s in open_ if target[s] > 3 * sizes[s]}
        if not over:
            break
        capped |= over
    assert got == pytest.approx(target)


def test_mixing_cases(spark):
    docs = frame(spark, odd_rows())
    out = mixing.mixed(docs).collect()
    assert len(out) == 7 and all(r.taken <= 3 * r.size for r in out)
    assert sorted(map(str, out)) == sorted(map(str, mixing.mixed(docs.repartition(3)).collect()))
    emitted = mixing.emit(docs)
    assert emitted.columns == docs.columns and emitted.count() == sum(r.copies for r in out)
    assert mixing.mixed(docs.limit(0)).collect() == []
    assert mixing.emit(docs.limit(0)).collect() == []
    many = spark.range(4000).selectExpr("id doc_id", "repeat('w ', cast(1 + id % 50 as int)) text", "concat('s', cast(id % 3 as string)) source")
    sums = mixing.mixed(many).groupBy("source").agg(F.sum("taken").alias("t"), F.first("target").alias("x")).collect()
    assert all(abs(r.t - r.x) < 0.02 * r.x for r in sums)


def brute_copies(rows, rates, seed):
    """Copies of ``(doc_id, source, text)`` rows, cell by cell in plain loops."""
    import re

    number = lambda x: int(hashlib.sha256(x.encode()).hexdigest()[:13], 16)
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    draw = lambda i, t: number(f"{seed}:{'' if i is None else i}:{hashlib.md5((t or '').encode()).hexdigest()}")
    out = []
    for source in {r[1] for r in rows}:
        whole, part = divmod(rates[source], 1)
        start, before = number(f"{seed}:source:{source or ''}") / 16**13, 0
        own = [r for r in rows if r[1] == source]
        for bits in sorted({size(t).bit_length() for _, _, t in own}):
            cell = sorted(((draw(i, t), i, t) for i, _, t in own if size(t).bit_length() == bits), key=lambda x: x[0])
            extra = int(start + part * (before + len(cell))) - int(start + part * before)
            border = cell[extra - 1][0] if extra else -1
            out += [(i, source, size(t), int(whole) + (d <= border)) for d, i, t in cell]
            before += len(cell)
    return out


@pytest.mark.parametrize("seed", ["mix", "other"])
def test_mixing_against_brute_force(spark, seed):
    rng = random.Random(seed)
    rows = [(k % 190, rng.choice(["a", "a", "a", "b", "c", None]), "w " * int(rng.paretovariate(0.8))) for k in range(200)] + [(None, "a", "x y"), (None, "a", "x y"), (None, None, None), (300, "z", None)]
    out = mixing.mixed(frame(spark, rows, "doc_id long, source string, text string"), seed).collect()
    rates = {r.source: r.target / r.source_size if r.source_size else 0.0 for r in out}
    assert sorted(((r.doc_id, r.source, r.size, r.copies) for r in out), key=str) == sorted(brute_copies(rows, rates, seed), key=str)


def test_rows_of_one_id_draw_apart(spark):
    rows = [(7 if k % 2 else k, "s", f"t{k} " * (40 + k % 9)) for k in range(1000)] + [(5000 + k, "t", f"u{k} " * 50) for k in range(700)]
    out = mixing.mixed(frame(spark, rows, "doc_id long, source string, text string")).collect()
    for source in "st":
        own = [r for r in out if r.source == source]
        assert abs(sum(r.taken for r in own) - own[0].target) <= 2 * max(r.size for r in own)


def test_each_document_is_copied_with_the_fraction_as_its_probability():
    rng = random.Random(1)
    rows = [(k, "s", "w " * int(rng.paretovariate(0.8))) for k in range(40)]
    copied, total = Counter(), sum(len(t.split()) for _, _, t in rows)
    misses = []
    for trial in range(2000):
        out = brute_copies(rows, {"s": 1.3}, f"seed{trial}")
        copied.update({i: c - 1 for i, _, _, c in out})
        misses.append(abs(sum(n * c for _, _, n, c in out) / total - 1.3))
    assert all(abs(copied[k] / 2000 - 0.3) < 0.06 for k in range(40))
    # independent draws miss the target by more
    sizes = [len(t.split()) for _, _, t in rows]
    plain = [abs(sum(n for n in sizes if rng.random() < 0.3) / total - 0.3) for _ in range(2000)]
    assert sum(misses) < sum(plain)


# --- byte-level BPE ---------------------------------------------------------------------------------------------

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def bpe():
    with open(RANKS) as lines:
        return byte_bpe.ByteBPE(byte_bpe.load_ranks(lines), public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def library():
    with open(RANKS, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_equals_the_library(bpe, library):
    rng = random.Random(3)
    parts = ["a", "the", "ing", " ", "  ", "\n", "=", "-", "12", "é", "😀", "'s", "'", "\x1c", "\x85", "\u3000", "ß", "<|endoftext|>", "\x00"]
    texts = ["".join(rng.choices(parts, k=rng.randrange(60))) for _ in range(3000)] + ["", "a" * 50_000, " " * 50_000, "ab" * 20_000, "".join(rng.choices("abcdefgh", k=50_000))]
    for t in texts:
        ids = bpe.encode(t)
        assert array("I", ids).tolist() == library.encode_ordinary(t)
        assert bpe.decode(ids) == t.encode()


def test_long_pieces_take_linear_time(bpe):
    import time

    rng = random.Random(6)
    for letters in ("a", "ab", "abcdefgh"):
        text = "".join(rng.choices(letters, k=400_000))
        seconds = []
        for n in (100_000, 400_000):
            began = time.process_time()
            bpe.encode(text[:n])
            seconds.append(time.process_time() - began)
        assert seconds[1] < 12 * seconds[0] + 0.5


def test_bpe_frame(spark, library):
    docs = frame(spark, odd_rows()).withColumn("n_tokens", F.lit("clash"))
    out = byte_bpe.encode_documents(docs, RANKS, public_tokenizers.PATTERN, keep_ids=True).collect()
    assert len(out) == 7
    for r, (doc_id, text, *_) in zip(sorted(out, key=lambda r: (r.doc_id is None, r.doc_id, r.n_tokens)), sorted(odd_rows(), key=lambda r: (r[0] is None, r[0])), strict=True):
        ids = library.encode_ordinary(text or "")
        assert (r.doc_id, r.n_tokens, r.ids) == (doc_id, len(ids), ids)
        assert r.ids_sha256 == hashlib.sha256(array("I", ids).tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()


# --- HTML -------------------------------------------------------------------------------------------------------


@pytest.mark.parametrize(
    ("html", "text"),
    [
        (None, ""),
        ("", ""),
        ("plain", "plain"),
        ("<p>a<p>b &amp;&lt; c", "a\nb &< c"),
        ("<nav>m</nav><article><h1>T</h1><p>One\n two</p><aside>s</aside><p>x.</p></article><footer>f</footer>", "T\nOne two\nx."),
        ("<article><p><b>bold<br><p>next</article><div class='ad'>buy</div>", "bold\nnext"),
        ("<head><title>t</title><style>p{}</style></head><body><script>var t='</p>';</script><main><p>text</p></main></body>", "text"),
        ("<article><p>body</p><section id=comments><p>" + "comment " * 40 + "</p></section></article>", "body"),
        ("<div class=menu>a</div><div><h2>T</h2><p>" + "long text " * 30 + "</p><p>s</p></div><div><a href=x>l</a></div>", "T\n" + ("long text " * 30).strip() + "\ns"),
        ("<!-- c --><form><p>x</p></form>", ""),
    ],
)
def test_main_text(html, text):
    assert html_extract.main_text(html) == text


def test_no_part_of_an_article_is_lost():
    long, some, quote = ("long text " * 30).strip(), ("some more " * 12).strip(), ("quoted words " * 150).strip()
    menu, links = "<div class=menu>m</div>", "<div><a href=x>l</a></div>"
    parts = f"<body>{menu}<div><h2>T</h2><div><p>{long}</p></div><section><p>{some}</p></section><div><p>{some} end</p></div></div>{links}</body>"
    assert html_extract.main_text(parts) == f"T\n{long}\n{some}\n{some} end"
    quoted = f"<body>{menu}<div><p>first {some}</p><p>{some}</p><blockquote><p>{quote}</p><p>{quote}</p></blockquote><p>{some}</p><p>last {some}</p></div>{links}</body>"
    assert html_extract.main_text(quoted) == "\n".join((f"first {some}", some, quote, quote, some, f"last {some}"))
    several = f"<body><p>x</p><article><p>{long}</p></article><article><p>{some}</p></article><article><p>short</p></article></body>"
    assert html_extract.main_text(several) == f"{long}\n{some}\nshort"
    only = f"<body>{menu}<div><blockquote><p>{long}</p></blockquote><p>s</p></div>{links}</body>"
    assert html_extract.main_text(only) == f"{long}\ns"


def test_lists_of_links_go_at_the_ends_only():
    long = ("long text " * 30).strip()
    links = "".join(f"<li><a href=x>some link {k}</a></li>" for k in range(4))
    page = f"<article><ul>{links}</ul><h1>T</h1><p>{long}</p><ul>{links}</ul><p>{long} end</p><p><a href=x>more</a></p></article>"
    inner = "\n".join(f"some link {k}" for k in range(4))
    assert html_extract.main_text(page) == f"T\n{long}\n{inner}\n{long} end\nmore"
    assert html_extract.main_text(f"<article><ul>{links}</ul></article>") == inner


def test_smoothed_ratios_are_a_gaussian_mean():
    import math

    rng = random.Random(2)
    for n in (1, 2, 3, 9, 40):
        ratios = [rng.random() * 100 for _ in range(n)]
        for i, got in enumerate(html_extract.smoothed(ratios)):
            weights = [math.exp(-((i - k) ** 2) / (2 * html_extract.SMOOTH**2)) if abs(i - k) <= 2 else 0.0 for k in range(n)]
            assert got == pytest.approx(sum(w * r for w, r in zip(weights, ratios, strict=True)) / sum(weights))


def test_common_container_against_brute_force():
    rng = random.Random(3)
    for _ in range(100):
        boxes = [html_extract.Box("body", 0, None)]
        around, number = boxes[0], 0
        for _ in range(30):  # a walk that opens and closes containers
            if rng.random() < 0.6 or around.parent is None:
                number += 1
                around = html_extract.Box(rng.choice(["div", "section", "blockquote"]), number, around)
                boxes.append(around)
            else:
                around.last = number
                around = around.parent
        chosen = rng.sample(boxes, rng.randrange(1, 6))

        def chain(b):
            return [b, *chain(b.parent)] if b else []

        shared = [b for b in chain(chosen[0]) if all(b in chain(c) for c in chosen)]
        assert html_extract.common(chosen) is next(b for b in shared if b.name != "blockquote")
        for b in boxes:
            assert [b.holds(c) for c in boxes] == [b in chain(c) for c in boxes] or any(c.last == float("inf") for c in chain(b))


def test_broken_pages_take_linear_time_and_memory():
    import time
    import tracemalloc

    for part in ("<a ", "<!--", "<![CDATA[", "<![x[", "<", "</p>", "<div>", "<div>x", "<b><p></p>", "<p><b>", "<a x='", "<?x ", "</a ", "<article>x"):
        for page in (part * 50_000 + "<p>end</p>", "<p>a</p>" + part * 50_000):
            began = time.time()
            tracemalloc.start()
            html_extract.main_text(page)
            most = tracemalloc.get_traced_memory()[1]
            tracemalloc.stop()
            assert time.time() - began < 15 and most < 200e6, part


def test_stray_signs_do_not_turn_markup_into_text():
    """Equal markup gives equal text, with a few stray signs or with thousands."""
    for n in (3, 3000):
        script = "<script>" + "if (a < b && b < c) x(); " * n + "</script>"
        page = f"<article><!-- <div>old</div> -->{script}<p title='a < b'>text</p></article>" + "<" * n
        assert html_extract.main_text(page) == "text"


def test_html_frame(spark):
    pages = spark.createDataFrame([(1, None, None), (2, "u", "<p>a</p>"), (2, "u", "<p>a</p>"), (None, "v", "<p>" * 5000 + "deep")], "page_id long, url string, html string").withColumn("text", F.lit("clash"))
    out = html_extract.extract_pages(pages).collect()
    assert sorted((r.page_id or 0, r.text) for r in out) == [(0, "deep"), (1, ""), (2, "a"), (2, "a")]
    assert html_extract.extract_pages(pages.limit(0)).collect() == []


# --- SpotSigs ---------------------------------------------------------------------------------------------------


def brute_signatures(text):
    import re

    words = [w for w in re.split(r"[\W_]+", (text or "").lower()) if w]
    anchors = set(spotsigs.ANCHORS)
    spots, held = [], []
    for w in words:
        if w in anchors:
            held.append(w)
        else:
            spots.append(("".join(a + "\x02" for a in held) + w, w, bool(held)))
            held = []
    out = set()
    for k, (own, _, marked) in enumerate(spots):
        if marked or not any(s[2] for s in spots[max(0, k - spotsigs.LONELY) : k]):
            out.add(" ".join([own] + [s[1] for s in spots[k + 1 : k + spotsigs.CHAIN]]))
    return out or ({"".join(w + "\x02" for w in words)} if words else set())


def test_spotsigs_against_brute_force(spark):
    rng = random.Random(4)
    vocabulary = ["the", "of", "and", "der", "que", "tree", "house", "river", "stone", "cloud", "é", "9"]
    rows = [(k * 3, " ".join(rng.choices(vocabulary, k=rng.randrange(40))) + rng.choice(["", "!", "\n"])) for k in range(40)]
    rows += [(1000, None), (1001, ""), (1002, "the of"), (1003, rows[0][1]), (1004, rows[0][1]), (5, "tree " * 20_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("range_no", F.lit("clash"))
    out = {r.doc_id: r for r in spotsigs.compare_with_edited(docs).collect()}
    ordered = sorted(((i, t or "") for i, t in rows), reverse=True)
    assert len(out) == len(rows)

    def alike(a, b):
        return 1.0 if not a and not b else len(a & b) / len(a | b)

    for k, (i, text) in enumerate(ordered):
        following = ordered[(k + 1) % len(ordered)][1]
        n = len(text) // 3
        edited = text[: len(text) - n] + following[:n]
        r = out[i]
        assert (r.n_chars, r.edited) == (len(text), edited)
        assert len(r.signatures) == len(brute_signatures(text))
        assert r.near_edited == pytest.approx(alike(brute_signatures(text), brute_signatures(edited)))
        assert r.near_next == pytest.approx(alike(brute_signatures(text), brute_signatures(following)))
    assert out[1003].signatures == out[1004].signatures


def test_spotsigs_ranges_split_rows_without_ids_and_repeated_ids(spark):
    """A hot id and rows without one are dealt into several ranges; successors follow (id descending, hash of the text)."""
    texts = [f"the word{k} of tree{k % 7} and house{k}" for k in range(300)]
    rows = [(None if k % 3 == 0 else 50 if k % 3 == 1 else k, t) for k, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    dealt = spotsigs.with_next(docs)
    sizes = [r["count"] for r in dealt.where("not is_halo").groupBy("range_no").count().collect()]
    assert sum(sizes) == 300 and max(sizes) <= 60 and len(sizes) == dealt.where("is_halo").count()
    hashes = dict(docs.select("text", F.xxhash64("text")).collect())
    ordered = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), hashes[r[1]]))
    out = {r.edited: r for r in spotsigs.compare_with_edited(docs).collect()}
    for k, (_, text) in enumerate(ordered):
        following = ordered[(k + 1) % 300][1]
        n = len(text) // 3
        assert text[: len(text) - n] + following[:n] in out


def test_borders_above(spark):
    for n in (0, 1, 2, 5, 17):
        borders = sorted(random.Random(n).sample(range(100), n))
        got = spark.range(-1, 101).select("id", spotsigs._above(borders, F.col("id"))).collect()
        assert all(found == sum(b > x for b in borders) for x, found in got)


def test_spotsigs_reports_small_likenesses(spark):
    long = " ".join(f"the word{k} thing" for k in range(600))
    rows = [(2, "the word5 thing the word6 thing"), (1, long)]
    out = {r.doc_id: r for r in spotsigs.compare_with_edited(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert 0 < out[2].near_next < 0.01


def test_spotsigs_cases(spark):
    out = spotsigs.compare_with_edited(frame(spark, odd_rows())).collect()
    assert len(out) == 7
    assert spotsigs.compare_with_edited(frame(spark, []).limit(0)).collect() == []
    pair = spark.createDataFrame([([1, 2, 3, 4], [3, 4, 5]), ([1], list(range(1, 200)))], "a array<bigint>, b array<bigint>")
    assert [r[0] for r in pair.select(spotsigs.likeness(F.col("a"), F.col("b"), 0.01)).collect()] == [0.4, 0.0]


# --- WebP -------------------------------------------------------------------------------------------------------


def images(n=40):
    rng = np.random.default_rng(6)
    for _ in range(n):
        h, w = (int(x) for x in rng.integers(1, 20, 2))
        kind = rng.integers(0, 4)
        if kind == 0:
            image = rng.integers(0, 2**32, (h, w), dtype=np.uint32)
        elif kind == 1:
            image = rng.choice(rng.integers(0, 2**32, int(rng.integers(1, 40)), dtype=np.uint32), (h, w))
        elif kind == 2:
            image = np.full((h, w), 7, np.uint32)
        else:
            image = np.add.outer(np.arange(h), np.arange(w)).astype(np.uint32) * np.uint32(0x01010101)
        yield rng, image.astype(np.uint32)


@pytest.mark.parametrize("in_arrays", [True, False])
def test_webp_round_trip(monkeypatch, in_arrays):
    if not in_arrays:
        monkeypatch.setattr(webp, "decode_in_arrays", lambda *a: None)
    for rng, image in images():
        h, w = image.shape
        palette = bool(rng.integers(0, 2))
        colours = len(np.unique(image))
        coded = -(-w >> webp.bundle_bits(colours)) if palette and colours <= 256 else w
        tile = int(rng.integers(2, 5))
        shape = (-(-h >> tile), -(-coded >> tile))
        options = webp.Options(
            cache_bits=int(rng.choice([0, 3, 8, 11])),
            copies=bool(rng.integers(0, 2)),
            far_copies=bool(rng.integers(0, 2)),
            palette=palette,
            subtract_green=bool(rng.integers(0, 2)),
            predictor=rng.integers(0, 14, shape).astype(np.uint32) << np.uint32(8) if rng.integers(0, 2) else None,
            cross_colour=rng.integers(0, 2**32, shape, dtype=np.uint32) if rng.integers(0, 2) else None,
            tile=tile,
        )
        assert (webp.decode(webp.encode(image, options)) == image).all(), options


def test_webp_reads_groups_and_far_copies():
    """A stream with two groups of codes by tile, and a copy from the row above."""
    out = webp.BitWriter()
    width, height = 8, 8
    for value, n in ((0x2F, 8), (width - 1, 14), (height - 1, 14), (1, 1), (0, 3), (0, 1), (0, 1), (1, 1), (0, 3)):
        out.write(value, n)
    groups = np.array([0, 1, 1, 0], np.uint32) << np.uint32(8)
    webp.write_pixels(out, groups, webp.Options())
    green = [0] * 280
    for symbol in (10, 20, 256 + 1):
        green[symbol] = 2
    green[256 + 2] = 2
    for red in (1, 2):
        webp.write_prefix_code(out, green)
        webp.write_prefix_code(out, [0] * 256, red)
        webp.write_prefix_code(out, [0] * 256, 3)
        webp.write_prefix_code(out, [0] * 256, 255)
        webp.write_prefix_code(out, [0] * 40, 0)  # distance code 1: the pixel above
    codes = webp.canonical(green)
    want = np.zeros((height, width), np.uint32)
    for y in range(height):
        x = 0
        while x < width:
            if y % 2 and x % 4 == 0:
                out.write(int(codes[257]), 2)  # two pixels from above
                want[y, x : x + 2] = want[y - 1, x : x + 2]
                x += 2
            else:
                symbol = 10 if (x + y) % 3 else 20
                out.write(int(codes[symbol]), 2)
                red = 1 + int(groups[(y >> 2) * 2 + (x >> 2)] >> 8)
                want[y, x] = 255 << 24 | red << 16 | symbol << 8 | 3
                x += 1
    body = np.packbits(out.bits(), bitorder="little").tobytes() + b"\0\0"
    data = b"RIFF" + (12 + len(body)).to_bytes(4, "little") + b"WEBPVP8L" + len(body).to_bytes(4, "little") + body
    assert (webp.decode(data) == want).all()


def test_media_frame(spark):
    docs = frame(spark, odd_rows()).withColumn("media", F.lit("clash"))
    out = media_columns.media_columns(docs).collect()
    assert len(out) == 7
    for r in out:
        text = {x[0]: x[1] for x in odd_rows()}[r.doc_id] or ""
        data = text.encode()
        assert bytes(r.samples) == data + bytes(-len(data) % 64 if data else 64) and r.n_bytes == len(data)
        assert bytes(r.samples) == media_columns.read_back([bytes(m) for m in r.media], len(r.samples))
    for data in (bytes(range(256)) * 40, bytes(100_000), b"ab" * 40_000):
        assert media_columns.read_back(media_columns.store(media_columns.padded(data)), len(data)) == data
    # a payload of more than one image
    data = media_columns.padded(b"several images hold it " * 100)
    files = media_columns.store(data, 256)
    assert len(files) == -(-len(data) // 256) > 1 and media_columns.read_back(files, len(data), 256) == data


def test_each_profile_is_taken_where_it_is_smallest():
    """Texts of the kinds that the profiles are for; each file holds the transforms of its profile and is read back."""
    rng = random.Random(5)
    prose = " ".join("".join(rng.choices("etaoinshrdlu", k=rng.randrange(2, 9))) for _ in range(500)).encode()
    line = "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=240)).encode()
    noise = [bytes(rng.choices(range(33, 126), k=4)) for _ in range(3)]
    payloads = {0: prose, 1: line * 9, 2: b"".join(rng.choices(noise, k=600))}
    numbers = np.random.default_rng(2)
    payloads[3] = np.cumsum(numbers.integers(-1, 2, (2048, 4)), 0).astype(np.uint8).tobytes()  # slow ramps
    payloads[4] = (np.cumsum(numbers.integers(0, 2, (128, 1)), 0) + numbers.integers(0, 256, (1, 64))).astype(np.uint8).tobytes()  # rows alike
    for want, data in payloads.items():
        padded = media_columns.padded(data)
        image = np.frombuffer(padded, "<u4").reshape(-1, 16)
        file, taken = webp.encode_smallest(image, media_columns.PROFILES)
        assert taken == want and (webp.decode(file) == image).all()
        sizes = [len(webp.encode(image, p)) for p in media_columns.PROFILES if not p.palette or len(np.unique(image)) <= 256]
        assert len(file) <= min(sizes) * 1.1 + 60


def test_bits_needed_are_those_written():
    for _, image in images():
        for options in (p for p in media_columns.PROFILES if not p.palette):
            out = webp.BitWriter()
            pixels = webp.transformed(image, options).ravel()
            webp.write_pixels(out, pixels, options, main=True)
            flags = 2 + 4 * bool(options.cache_bits)
            assert len(out.bits()) == flags + webp.bits_needed(pixels, options)


def test_predictor_modes_against_the_plain_rule():
    """Every mode, pixel by pixel in plain loops."""
    rng = np.random.default_rng(8)

    def plain(residual, modes):
        h, w = residual.shape
        out = np.zeros((h, w, 4), int)
        parts = webp.channels(residual)
        for y in range(h):
            for x in range(w):
                if not y:
                    guess = out[0, x - 1] if x else np.array([255, 0, 0, 0])
                elif not x:
                    guess = out[y - 1, 0]
                else:
                    right = out[y - 1, x + 1] if x + 1 < w else out[y, 0]
                    args = [np.asarray(v, np.int32)[None] for v in (out[y, x - 1], out[y - 1, x], right, out[y - 1, x - 1])]
                    guess = webp.predicted(np.array([modes[y >> 2, x >> 2]]), *args)[0]
                out[y, x] = (parts[y, x] + guess) & 255
        return webp.joined(out.astype(np.int32))

    for h, w in ((1, 1), (1, 9), (9, 1), (7, 10), (12, 5)):
        residual = rng.integers(0, 2**32, (h, w), dtype=np.uint32)
        shape = (-(-h >> 2), -(-w >> 2))
        for modes in [*(np.full(shape, m) for m in range(16)), rng.integers(0, 14, shape)]:
            got = webp.invert_predictor(residual, modes.astype(np.uint32) << np.uint32(8), 2)
            assert (got == plain(residual, modes)).all()


# --- windows and substring dedup --------------------------------------------------------------------------------


def test_packing():
    rng = np.random.default_rng(7)
    for top in (1, 10, 10**4, 2**31, 2**40):
        for n in (0, 1, 2, 500):
            x = np.sort(rng.integers(0, top, n))
            assert (windows.unpack(windows.pack(x)) == x).all()
            assert (windows.unpack(windows.pack(np.unique(x))) == np.unique(x)).all()
    doc = np.array([-5, -5, 3, 3, 3, 2**40]); part = np.array([0, 1, 0, 0, 0, 0], np.int32); pos = np.array([7, 2, 0, 300, 100_000, 1], np.int32)
    back = substring_dedup.unpack_places(*substring_dedup.pack_places(doc, part, pos))
    assert all((a == b).all() for a, b in zip(back, (doc, part, pos), strict=True))


def brute_dedup(rows, size):
    import re

    words = [(i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in rows]
    least = {}
    for i, w in words:
        for k in range(len(w) - size + 1):
            if i is not None:
                least[tuple(w[k : k + size])] = min(i, least.get(tuple(w[k : k + size]), i))
    out = []
    for i, w in words:
        gone = set()
        for k in range(len(w) - size + 1):
            if i is not None and least[tuple(w[k : k + size])] < i:
                gone |= set(range(k, k + size))
        kept = [x for k, x in enumerate(w) if k not in gone]
        out.append((i, len(w), len(gone), hashlib.sha256(" ".join(kept).encode()).hexdigest()))
    return sorted(out, key=str)


def test_sketch_keeps_pace_with_the_data():
    """Cells, slices and blocks grow with the input, so single windows pass as rarely at any size and no task grows on."""
    sizes = [windows.Sizes.for_bytes(10**k, 200) for k in range(6, 15)]
    assert max(s.pass_rate for s in sizes) < 0.06
    assert max(s.slice_cells for s in sizes) <= 4 * windows.CELLS_PER_WINDOW * 2**20 + 8
    assert max(10**k / s.blocks for k, s in zip(range(6, 15), sizes, strict=True)) <= 2**25


def test_sketch_rows_follow_the_windows():
    """Not blocks times slices: up to 100 TB a window costs about as many bytes, under twice its text, and rows stay few beside the windows."""
    for k in range(9, 15):
        sizes = windows.Sizes.for_bytes(10**k, 2000)
        assert sizes.bytes_sent < 2 * 10**k
        assert sizes.rows_sent <= max(2 * windows.DIRECT_ROWS, sizes.windows / 100)
    assert windows.Sizes.for_bytes(30 * 10**9, 3000).super_blocks == 0 < windows.Sizes.for_bytes(10**12, 3000).super_blocks


@pytest.mark.parametrize("hub", [components.HUB_EDGES, 0])
def test_components_of_hubs_and_chains(spark, monkeypatch, hub):
    monkeypatch.setattr(components, "HUB_EDGES", hub)
    edges = [(k, 5) for k in range(6, 400)] + [(1000 + k, 1001 + k) for k in range(60)] + [(7, 2000), (3000, 3000)]
    found = {r.node: r.component for r in components.connected(spark.createDataFrame(edges, "a long, b long"), "test").collect()}
    assert found == {k: 5 for k in [*range(5, 400), 2000]} | {1000 + k: 1000 for k in range(61)}


def test_two_levels_answer_as_one(spark):
    rng = random.Random(11)
    rows = [(k, k % 7, " ".join(rng.choices("abcdefgh", k=rng.randrange(60))).encode()) for k in range(120)]
    blocked = spark.createDataFrame(rows, "doc_id long, block int, data binary")
    hashes = lambda table: windows.concatenated(windows.window_hashes(windows.word_hashes(x.as_py()), 4) for x in table["data"])
    plain = windows.Sizes(4000, 7, 13, 300)
    table = blocked.toArrow()
    expected = {r["block"]: [] for r in table.select(["block"]).to_pylist()}
    for sizes in (plain, plain.two_levels(4, 3), plain.two_levels(1, 1), plain.two_levels(20, 100)):
        found = windows.block_answers(blocked, hashes, sizes).toArrow()
        for block in expected:
            own = hashes(table.filter([x == block for x in table["block"].to_pylist()]))
            levels = windows.Answers(found.filter([x == block for x in found["block"].to_pylist()]), sizes).levels(own).tolist()
            if sizes is plain:
                expected[block] = levels
            assert levels == expected[block]
    assert len({x for levels in expected.values() for x in levels}) > 3


def test_estimates_are_never_too_low():
    rng = np.random.default_rng(3)
    parts = [rng.integers(0, 300, 200, np.uint64) * np.uint64(2**57 + 12345) for _ in range(3)]
    sizes = windows.Sizes(600, 3, 4, 16)
    counts = {}
    for row in range(windows.DEPTH):
        for p in parts:
            for c in list(sizes.cells(p))[row].tolist():
                counts[row, c] = counts.get((row, c), 0) + 1
    for p in parts:
        cells = list(sizes.cells(p))
        for k, h in enumerate(p):
            true = sum(int((q == h).sum()) for q in parts)
            assert min(counts[row, int(cells[row][k])] for row in range(windows.DEPTH)) >= true
    assert (np.diff(windows.level(np.arange(1, 10**6)).astype(int)) >= 0).all()
    assert windows.level(np.array([1, 2]))[1] > 1


@pytest.mark.parametrize(("cells", "hot"), [(4, 1000), (0.01, 1000), (4, 1), (0.01, 2)])
def test_substring_dedup(spark, cells, hot):
    rng = random.Random(8)
    passages = [" ".join(rng.choices("abcdefghij", k=rng.randrange(3, 30))) for _ in range(12)]
    rows = [(rng.randrange(-5, 60), "\n".join(rng.choices(passages, k=rng.randrange(4)) + [" ".join(rng.choices("xyz", k=rng.randrange(12)))])) for _ in range(80)]
    rows += [(r[0], r[1]) for r in odd_rows()] + [(70, "spam " * 500), (71, "spam " * 400), (72, "\u3000".join("abcdefghijklmnop"))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("key", F.lit("clash")).withColumn("dedup", F.lit("taken"))
    out = substring_dedup.deduplicated(docs, size=5, cells_per_window=cells, hot=hot)
    assert out.columns == docs.columns
    got = [(r.doc_id, r.dedup.n_words, r.dedup.n_removed, r.dedup.kept_sha256) for r in out.collect()]
    assert sorted(got, key=str) == brute_dedup(rows, 5)
    untouched = {(r.doc_id, r.text) for r in out.where("dedup.n_removed = 0").collect()}
    assert untouched <= set(rows)
    assert substring_dedup.deduplicated(docs.limit(0)).collect() == []
    with pytest.raises(TypeError):
        substring_dedup.deduplicated(docs.withColumn("doc_id", F.lit("x")))


# --- n-gram Jaccard join ----------------------------------------------------------------------------------------


def brute_groups(rows, size):
    import re

    sets = []
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets.append((i, {tuple(w)} if 0 < len(w) < size else {tuple(w[k : k + size]) for k in range(len(w) - size + 1)}))
    parent = list(range(len(rows)))

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for a, b in combinations(range(len(rows)), 2):
        (i, x), (j, y) = sets[a], sets[b]
        if i is None or j is None:
            continue
        if (i == j and x and y) or (x and y and 100 * len(x & y) >= 80 * len(x | y)):
            parent[find(a)] = find(b)
    out = []
    for k, (i, x) in enumerate(sets):
        members = [sets[m][0] for m in range(len(rows)) if find(m) == find(k)]
        out.append((i, len(x), None if i is None else min(members)))
    return sorted(out, key=str)


def near_rows(seed, n=160):
    rng = random.Random(seed)
    bases = [[rng.choice("abcdefghijklmnopqrstuvwxyz") + str(rng.randrange(9)) for _ in range(rng.randrange(1, 90))] for _ in range(14)]
    rows = []
    for k in range(n):
        words = list(rng.choice(bases))
        for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 6])):
            words[rng.randrange(len(words))] = f"edit{rng.randrange(5)}"
        if rng.random() < 0.2:
            words += rng.choice(bases)
        rows.append((k * 7 % 1000 - 50, rng.choice([" ", "\n", "\t "]).join(w.upper() if rng.random() < 0.1 else w for w in words)))
    return rows


@pytest.mark.parametrize(("seed", "part", "cells", "stars"), [(1, 250, 4, 2), (2, 2, 4, 1), (3, 3, 0.01, 0), (4, 1, 4, 0)])
def test_ngram_join(spark, seed, part, cells, stars):
    rows = near_rows(seed) + [(r[0] + 5000 if r[0] else None, r[1]) for r in odd_rows()] + [(9000, "A b"), (9001, "a  b"), (9002, "a b c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("node", F.lit("clash"))
    got = [(r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.group_documents(docs, part=part, cells_per_window=cells, stars=stars).collect()]
    assert sorted(got, key=str) == brute_groups(rows, 5)


def test_a_large_family_is_sent_a_bounded_number_of_times(spark, monkeypatch):
    """Distinct near copies of one template: one component, and each text goes to few tasks, none of which holds the family."""
    rng = random.Random(11)
    template = [f"w{rng.randrange(5000)}" for _ in range(150)]
    rows = []
    for k in range(1200):
        words = list(template)
        for _ in range(rng.randrange(1, 3)):
            words[rng.randrange(150)] = f"own{rng.randrange(10**6)}"
        rows.append((k, " ".join(words)))
    sent = []
    walk = ngram_join._walk

    def counted(texts, *rest):
        tasks = [r["count"] for r in texts.groupBy("group", "i", "j").count().collect()]
        sent.append((sum(tasks), max(tasks, default=0)))
        return walk(texts, *rest)

    monkeypatch.setattr(ngram_join, "_walk", counted)
    out = ngram_join.group_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.component_id for r in out} == {0}
    assert sum(n for n, _ in sent) <= 3 * len(rows) and max(m for _, m in sent) <= 2.5 * ngram_join.PART


def test_components(spark):
    from lodeframe.llm.components import connected

    chain = [(k, k + 1) for k in range(40)] + [(100, 101), (105, 101), (200, 200), (7, 3)]
    out = {r.node: r.component for r in connected(spark.createDataFrame(chain, "a long, b long"), "t").collect()}
    assert out == {k: 0 for k in range(41)} | {100: 100, 101: 100, 105: 100}
    assert connected(spark.createDataFrame([], "a long, b long"), "t").collect() == []


def test_ngram_join_cases(spark):
    docs = spark.createDataFrame([], "doc_id int, text string")
    assert ngram_join.group_documents(docs).collect() == []
    assert ngram_join.group_documents(docs).dtypes[0] == ("doc_id", "int")


def test_trie_prunes_nothing_alike():
    rng = np.random.default_rng(9)
    for _ in range(20):
        sets = []
        base = rng.integers(0, 400, 60)
        for _ in range(25):
            s = base.copy()
            s[rng.integers(0, 60, rng.integers(0, 14))] = rng.integers(0, 400, 1)
            sets.append(np.unique(s[: rng.integers(30, 61)]).astype(np.uint64))
        sets = list({s.tobytes(): s for s in sets}.values())
        parent = list(range(len(sets)))

        def find(a, parent=parent):
            while parent[a] != a:
                a = parent[a]
            return a

        for a, b in combinations(range(len(sets)), 2):
            both = len(np.intersect1d(sets[a], sets[b]))
            if 5 * both >= 4 * (len(sets[a]) + len(sets[b]) - both):
                parent[find(a)] = find(b)
        want = {frozenset(m for m in range(len(sets)) if find(m) == find(k)) for k in range(len(sets))}
        own = list(range(len(sets)))
        for a, b in ngram_join.Trie(sets).links():
            own = [own[a] if x == own[b] else x for x in own]
        assert {frozenset(m for m in range(len(sets)) if own[m] == own[k]) for k in range(len(sets))} == want


def test_crc_fold_is_spark_s(spark):
    ids = spark.createDataFrame([(k,) for k in range(-3, 40)], "doc_id long")
    from lodeframe.llm.queries import held_out

    assert all(r[1] == (zlib.crc32(str(r[0]).encode()) % 3 == 1) for r in ids.select("doc_id", held_out()).collect())
