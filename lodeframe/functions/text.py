"""Text functions, as Columns."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable, Iterable, Mapping, Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

WHITE = r"(?U)\s+"
ASCII_WORD = "[A-Za-z0-9]"


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often a lambda in the body uses it."""
    return F.get(F.transform(F.array(value), lambda v: body(v)), 0)


#: Numbers that are added up one by one.
STRETCH = 64


def starts(lengths: Column) -> Column:
    """The sum of the numbers before each number of an array, stretch by stretch."""
    total = lambda xs: F.aggregate(xs, F.lit(0), lambda a, x: a + x)
    before = lambda xs: F.transform(xs, lambda _, k: total(F.slice(xs, F.lit(1), k)))

    def summed(parts: Column) -> Column:
        heads = bound(F.transform(parts, total), before)
        return F.flatten(F.zip_with(parts, heads, lambda part, head: F.transform(before(part), lambda x: x + head)))

    cut = lambda xs: F.transform(F.sequence(F.lit(0), F.greatest(F.floor((F.size(xs) - 1) / STRETCH), F.lit(0)).cast("int")), lambda k: F.slice(xs, k * STRETCH + 1, F.lit(STRETCH)))
    return bound(lengths, lambda xs: bound(cut(xs), summed))


def squeeze(text: Column) -> Column:
    """Outer white space away, inner runs to one space, by the Unicode property."""
    return F.regexp_replace(F.regexp_replace(text, r"(?U)^\s+|\s+$", ""), WHITE, " ")


def canonical_json(columns: Mapping[str, Column]) -> Column:
    """Compact JSON with keys in order and nulls kept."""
    return F.to_json(F.struct(*[columns[k].alias(k) for k in sorted(columns)]), {"ignoreNullFields": "false"})


def canonical_array(items: Column) -> Column:
    """An array of JSON strings as one JSON array, without regard to its order."""
    return F.concat(F.lit("["), F.array_join(F.array_sort(items), ","), F.lit("]"))


def fingerprint(text: Column, history: Column | None = None, now: Column | None = None) -> Column:
    """SHA-256 of the canonical JSON of (current_time, history, user_input), white space squeezed."""
    null = F.lit(None).cast("string")
    return F.sha2(canonical_json({"current_time": null if now is None else now, "history": F.array().cast("array<string>") if history is None else history, "user_input": squeeze(text)}), 256)


def signature(scenario: Column, patch: Column, state: Column) -> Column:
    """SHA-256 of what a record means: scenario, change and state as canonical JSON strings."""
    return F.sha2(F.to_json(F.array(scenario, patch, F.coalesce(state, F.lit("null")))), 256)


def ngrams(text: Column, size: int) -> Column:
    """Character n-grams; a shorter text is its own only gram, an empty one has none."""
    n = F.char_length(text)
    grams = F.transform(F.sequence(F.lit(1), F.greatest(n - size + 1, F.lit(1))), lambda k: F.substr(text, k, F.lit(size)))
    return F.when(n == 0, F.array().cast("array<string>")).when(n < size, F.array(text)).otherwise(grams)


def multiset_overlap(a: Column, b: Column) -> Column:
    """Size of the multiset intersection of two arrays."""
    count = lambda xs, x: F.size(F.filter(xs, lambda y: y == x))
    return bound(F.struct(a.alias("a"), b.alias("b")), lambda v: F.aggregate(F.array_distinct(v["a"]), F.lit(0), lambda acc, x: acc + F.least(count(v["a"], x), count(v["b"], x))))


def multiset_f1(a: Column, b: Column) -> Column:
    shared = multiset_overlap(a, b)
    total = F.size(a) + F.size(b)
    return F.when((F.size(a) == 0) | (F.size(b) == 0), F.lit(0.0)).otherwise(2 * shared / total)


def similarity(text: Column, reference: Column) -> Column:
    """Mean of the bigram and the trigram F1."""
    return (multiset_f1(ngrams(text, 2), ngrams(reference, 2)) + multiset_f1(ngrams(text, 3), ngrams(reference, 3))) / 2


def best_similarity(text: Column, references: Column) -> Column:
    """Likeness to the nearest of an array of references; without any it is 1."""
    return F.coalesce(F.array_max(F.transform(references, lambda r: similarity(text, r))), F.lit(1.0))


def replace_all(text: Column, pairs: Iterable[tuple[str, str]]) -> Column:
    """Replacements one after the other, in the order given."""
    return reduce(lambda acc, pair: F.replace(acc, F.lit(pair[0]), F.lit(pair[1])), pairs, text)


#: Phrases that a reply is normalised by, in the order of application (written hours: two before twelve).
REPLY_PHRASES = (
    ("一个半小时", "90分钟"), ("一個半小時", "90分钟"), ("1.5小时", "90分钟"), ("一个小时", "60分钟"), ("一個小時", "60分钟"), ("一小时", "60分钟"),
    ("1小时", "60分钟"), ("半个小时", "30分钟"), ("半個小時", "30分钟"), ("半小时", "30分钟"), ("两点", "2点"), ("二点", "2点"), ("三点", "3点"),
    ("四点", "4点"), ("五点", "5点"), ("六点", "6点"), ("七点", "7点"), ("八点", "8点"), ("九点", "9点"), ("十点", "10点"), ("十一点", "11点"),
    ("十二点", "12点"),
)
REPLY_MARKS = r"""(?U)[\s，。！？、；：,.!?;:'"“”‘’（）()【】\[\]—-]+"""


def normalize_reply(text: Column, phrases: Iterable[tuple[str, str]] = REPLY_PHRASES) -> Column:
    return F.regexp_replace(replace_all(F.lower(squeeze(text)), phrases), REPLY_MARKS, "")


#: What a normalised reply holds where it performs an act.
SPEECH_ACTS: dict[str, tuple[str, ...]] = {
    "ask_for_start_time": (
        "什么时候", "什么时间", "什么具体时间", "几点", "哪天", "预约时间", "具体时间.{0,8}(?:说|告知|提供|确定|方便)",
        "(?:告诉|告知|提供|说明).{0,8}(?:预约)?(?:日期|哪天).{0,8}(?:开始时间|时间|几点)", "(?:预约)?(?:具体)?日期.{0,4}(?:和|及|、)?(?:开始)?时间",
    ),
    "ask_for_duration": ("多久", "多长时间", "多少分钟", "几分钟", "服务时长", "时长.{0,8}(?:说|告知|提供|确定|方便)"),
    "inform_technician_available": (
        "技师.{0,8}有空", "技师.{0,8}(?<!不)可用", "技师.{0,8}(?<!不)可以服务", "(?<!不)可以.{0,8}安排.{0,8}技师", "技师.{0,8}(?<!不)可以为您", "(?<!没)有空", "(?<!不)可以服务",
        "技师.{0,24}(?<!不)可.{0,24}提供", "(?<!不)可.{0,24}提供", "(?<!不)可以.{0,24}提供", "(?<!不)可以.{0,8}安排", "已找到.{0,12}技师",
    ),
    "request_confirmation": ("确认", "您看.{0,8}可以吗", "这个安排.{0,8}可以吗", "需要.{0,12}安排吗", "是否.{0,12}安排", "您觉得.{0,8}可以吗"),
    "inform_technician_unavailable": (
        "技师.{0,8}没空", "技师.{0,8}没有空", "技师.{0,8}不可用", "技师.{0,8}排满", "技师.{0,12}无法.{0,8}提供", "技师.{0,12}不能.{0,8}提供", "无法.{0,12}提供.{0,8}服务",
    ),
    "inform_technician_not_found": ("没有找到.{0,8}技师", "找不到.{0,8}技师", "技师.{0,8}不存在", "暂无.{0,8}技师", "未能找到.{0,8}技师", "未找到.{0,12}技师"),
    "inform_no_match": ("没有.{0,12}符合.{0,12}技师", "没有匹配.{0,8}技师", "暂无.{0,12}合适.{0,8}技师", "未找到.{0,12}符合", "没有找到.{0,12}技师"),
    "acknowledge_booking_authorization": (
        "正在.{0,8}办理预约", "将为您.{0,8}办理", "为您处理预约", "授权.{0,8}创建预约", "确认.{0,16}提交预约", "提交.{0,8}预约", "上层.{0,8}创建预约",
    ),
    "acknowledge_result": ("好的", "了解", "知道了", "如需.{0,12}告诉我"),
    "acknowledge_pause": ("暂时.{0,6}不.{0,6}预约", "暂不.{0,6}预约", "先不.{0,6}预约", "需要时.{0,8}告诉我", "暂停预约"),
    "claim_booking_success": ("预约成功", "预约已成功", "预约好了", "已经.{0,8}预约", "已确认.{0,32}(?:预约|安排)", "已为您.{0,8}安排好", "已经.{0,8}安排好"),
}
#: Fixed value: a confirmed duration isn't a claim that the appointment is booked.
ONLY_DURATION = {"claim_booking_success": r"已确认\d+分钟服务"}


def has_act(said: Column, act: str) -> Column:
    """Whether a normalised reply performs an act."""
    if act not in SPEECH_ACTS:
        raise ValueError(f"unknown speech act {act!r}")
    left = F.regexp_replace(said, ONLY_DURATION[act], "") if act in ONLY_DURATION else said
    return left.rlike("|".join(f"(?:{p})" for p in SPEECH_ACTS[act]))


def acts_of(reply: Column) -> Column:
    """All acts that a reply performs, in the order of the table."""
    return bound(normalize_reply(reply), lambda said: F.array_compact(F.array(*[F.when(has_act(said, a), F.lit(a)) for a in SPEECH_ACTS])))


def reply_score(required_hits: Column, required: Column, likeness: Column) -> Column:
    """0.70 coverage of the required acts and 0.30 likeness; nothing required counts as covered."""
    coverage = F.when(required == 0, F.lit(1.0)).otherwise(required_hits / required)
    return 0.70 * coverage + 0.30 * likeness


def judge_reply(reply: Column, required: Column, forbidden: Column, references: Column) -> Column:
    """Score of a reply, whether it passes (all required acts, no forbidden one), and the forbidden acts it performs.

    The likeness to the references is that of the normalised texts.
    """

    def judged(acts: Column) -> Column:
        hits = F.size(F.filter(required, lambda a: F.array_contains(acts, a)))
        wrong = F.filter(forbidden, lambda a: F.array_contains(acts, a))
        score = reply_score(hits, F.size(required), best_similarity(normalize_reply(reply), F.transform(references, lambda r: normalize_reply(r))))
        return F.struct(score.alias("score"), ((hits == F.size(required)) & (F.size(wrong) == 0)).alias("passed"), wrong.alias("forbidden"))

    return bound(acts_of(reply), judged)


def mentions(text: Column, term: str) -> Column:
    """A term in a text: ASCII terms at word borders with flexible hyphens and spaces, others anywhere."""
    if not term.isascii():
        return F.contains(text, F.lit(term))
    flexible = r"[-_\s]+".join("".join(f"\\{c}" if not c.isalnum() else c for c in part) for part in term.replace("-", " ").replace("_", " ").split())
    return text.rlike(f"(?i)(?<!{ASCII_WORD}){flexible}(?!{ASCII_WORD})")


def numbers_in(text: Column) -> Column:
    """Standalone Arabic numbers of a text, as decimals."""
    return F.transform(F.regexp_extract_all(text, F.lit(r"(?<![\d.])(\d+(?:\.\d+)?)(?![\d.]*\d)"), 1), lambda x: x.cast("decimal(38,10)"))


def clauses(text: Column) -> Column:
    return F.filter(F.split(text, r"[，。！？；、,.!?;\n]+"), lambda x: F.trim(x) != "")


def redact(text: Column, secret: str, limit: int = 4000) -> Column:
    shown = F.replace(text, F.lit(secret), F.lit("***")) if secret else text
    return F.left(shown, F.lit(limit))


def sample_id(split: str, number: Column) -> Column:
    return F.format_string("%s-%06d", F.lit(split), number)


def safe_name(text: Column) -> Column:
    """A text as part of a file name."""
    return F.regexp_replace(text, r"[^A-Za-z0-9._-]+", "_")


def finite(x: Column) -> Column:
    """A number for a report: NaN and infinity become null."""
    return F.when(~F.isnan(x) & (F.abs(x) != float("inf")), x)


def hash_choice(key: Column, n: int) -> Column:
    """``sha256(key) % n`` for any small n, by its hex digits."""
    digits = F.split(F.sha2(key, 256), "")
    value = lambda d: F.conv(d, 16, 10).cast("int")
    return F.aggregate(F.filter(digits, lambda d: d != ""), F.lit(0), lambda acc, d: (acc * 16 + value(d)) % n)


def pick_unused(key: Column, choices: Sequence[str], used: Column) -> Column:
    """The choice that the key's hash names, or the next one in turn that ``used`` doesn't hold; null if all are used."""
    pool = F.array(*map(F.lit, choices))
    turned = bound(hash_choice(key, len(choices)), lambda k: F.concat(F.slice(pool, k + 1, F.lit(len(choices))), F.slice(pool, F.lit(1), k)))
    return F.get(F.filter(turned, lambda c: ~F.array_contains(used, c)), F.lit(0))


#: Words for a preference, by the preference that they mean, and signs of a refusal.
PREFERENCES: dict[str, tuple[str, ...]] = {
    "肩颈": ("肩颈", "颈肩", "肩膀和脖子", "脖子和肩膀", "肩颈放松", "颈肩放松"),
    "足部": ("足部", "足疗", "脚底按摩", "按脚", "脚部按摩", "足底"),
    "精油": ("精油", "精油按摩", "精油spa", "芳香精油", "喜欢精油"),
    "泰式": ("泰式", "泰式按摩"),
    "手法轻柔": ("手法轻柔", "力度轻一点", "轻柔", "轻一点", "不要太重"),
    "力度较重": ("力度大一些", "重一点", "手法重", "力度重"),
}
REFUSALS = ("不要", "不想", "不喜欢", "避免", "别用", "不能", "不需要")
PREFERENCE_MARKS = r"(?U)[\s，。！？、,.!?;；:：·\-_/]+"


def nfkc(text: Column) -> Column:
    """Compatibility composition, which Spark has no function for; over Arrow batches."""

    def composed(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: None if t is None else unicodedata.normalize("NFKC", t))

    return F.pandas_udf(composed, "string")(text)


def plain_preference(text: Column) -> Column:
    return F.regexp_replace(F.trim(F.lower(nfkc(text))), PREFERENCE_MARKS, "")


def meant_preference(plain: Column) -> Column:
    """The preference that a plain text stands for, null for none."""
    out = F.lit(None).cast("string")
    for name, words in PREFERENCES.items():
        out = F.when(plain.isin(*words), name).otherwise(out)
    return out


def refuses(plain: Column) -> Column:
    return plain.rlike("|".join(REFUSALS))
