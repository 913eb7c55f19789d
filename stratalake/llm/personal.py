"""Personal data: fixed rules, and bootstrapped contextual extraction of what the rules miss.

Spans of the fixed rules are the seeds, and so are long tokens of letters and digits, the secrets, which are a fifth rule: they are spans without the graph's say. Lexical patterns are the one, two or three words before a
span, the word after it, and its shape (each digit as 0, each letter as a or A); candidates are whatever else looks like an identifier: groups of digits joined
by single spaces, dots, hyphens or brackets, and tokens with several digits or an @. Patterns and instances (the tokens, in
lower case) form a graph. In each round a pattern is scored for a kind by the share of known instances of this kind among all
instances that it goes with, and an unknown instance by the noisy or of its good patterns; what
passes is known in the next round; rounds go on until there is nothing new. At the end, unknown tokens with a good pattern whose instance became
known are further spans of the pattern's kind.

Defined results: a null text is empty; spans count code points and their ends are exclusive; further spans never
overlap those of the rules; rows that share a doc_id and a text, null ids included, get the same spans; ties between kinds go to the
first in KINDS; words of a pattern count by their CONTEXT characters next to the span; other columns are ignored, whatever their names; a very
long text is searched as a whole, in time in proportion to its length; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stratalake.llm.tables import documents, written

#: The kinds of the fixed rules, and those that the method adds.
BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "secret")
#: A pattern is good with so many known instances, in this share of its instances; an instance is known from this score.
MIN_SUPPORT, MIN_CONFIDENCE, MIN_SCORE = 5, 0.8, 0.8
#: How far from an identifier words are looked for.
CONTEXT = 64
#: Kinds of slots that no rule found: candidates, and tokens within a candidate.
UNKNOWN, PART = -1, -2
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
#: What every token that looks like an identifier has.
_SIGN = re.compile("[0-9@]")
#: Groups of digits joined by single spaces, dots, hyphens or brackets.
_GROUPS = re.compile(r"\+?\(?[0-9]++(?:(?:\)[ .-]?\(?|[ .-]\(?|\()[0-9]++)*+")
_SECRET = re.compile(r"(?=(?:[A-Za-z_-]*[0-9]){6})(?=(?:[0-9_-]*[A-Za-z]){6})[A-Za-z0-9_-]{32,}={0,2}")
_SHAPE = str.maketrans({**dict.fromkeys("0123456789", "0"), **dict.fromkeys("abcdefghijklmnopqrstuvwxyz", "a"), **dict.fromkeys("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "A")})
_SPACE = " \t\n\x0b\x0c\r"
_EDGE = "\"'`.,;:!?()[]{}<>|"
FOUND = "doc_id bigint, t bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base string, slots array<struct<patterns:array<bigint>,instance:bigint,start:int,end:int,kind:int>>"


def emails(text: str) -> list[tuple[int, int]]:
    """From each @, back over what may stand before it and on over the domain: the same matches, in linear time."""
    out, free = [], 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append((start, m.end()))
            free = m.end()
        at = text.find("@", max(at + 1, free))
    return out


def luhn(digits: str) -> bool:
    total = sum(int(d) for d in digits[-1::-2]) + sum((0, 2, 4, 6, 8, 1, 3, 5, 7, 9)[int(d)] for d in digits[-2::-2])
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed rules, by start, then kind."""
    out = [(s, 0, e) for s, e in emails(text)] if "@" in text else []
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
            out.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 12 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= sum(c in "0123456789" for c in m.group()) <= 15:
                out.append((m.start(), 3, m.end()))
    return sorted(out)


def _code(s: str) -> int:
    return xxhash.xxh64_intdigest(s.encode("utf-8", "surrogatepass")) - (1 << 63)


def _looks_like_one(token: str) -> bool:
    return len(token) >= 6 and ("@" in token or sum(c in "0123456789" for c in token) >= 4)


def other_tokens(text: str, spans: list[tuple[int, int, int]]) -> Iterator[tuple[int, int, int]]:
    """(start, end, kind) of what looks like an identifier and touches no span of the rules.

    UNKNOWN are groups of digits that stand for themselves, and other tokens, unless they are secrets; PART are tokens within such groups.
    """
    taken: list[tuple[int, int]] = []  # the spans as disjoint stretches
    for s, _, e in spans:
        if taken and s <= taken[-1][1]:
            taken[-1] = (taken[-1][0], max(taken[-1][1], e))
        else:
            taken.append((s, e))

    def free(start: int, end: int) -> bool:
        before = bisect_left(taken, (end, 0)) - 1
        return before < 0 or taken[before][1] <= start

    groups: list[tuple[int, int]] = []
    for m in _GROUPS.finditer(text):
        start, end = m.start() + (m.group()[0] == "(" and ")" not in m.group()), m.end()
        if _looks_like_one(text[start:end]) and free(start, end):
            from_, to = start, end
            while from_ and text[from_ - 1] in _EDGE:
                from_ -= 1
            while to < len(text) and text[to] in _EDGE:
                to += 1
            if (not from_ or text[from_ - 1] in _SPACE) and (to == len(text) or text[to] in _SPACE):
                groups.append((start, end))
                yield start, end, UNKNOWN
    done = 0
    for m in _SIGN.finditer(text):
        if m.start() < done:
            continue
        start, end = m.start(), m.end()
        while start > done and text[start - 1] not in _SPACE:
            start -= 1
        while end < len(text) and text[end] not in _SPACE:
            end += 1
        done = end
        while start < end and text[start] in _EDGE:
            start += 1
        while end > start and text[end - 1] in _EDGE:
            end -= 1
        if _looks_like_one(text[start:end]) and free(start, end):
            within = bisect_left(groups, (start + 1, 0)) - 1
            if within < 0 or groups[within][1] < end:
                yield start, end, KINDS.index("secret") if _SECRET.fullmatch(text, start, end) else UNKNOWN
            elif groups[within] != (start, end):
                yield start, end, PART


def _slots(text: str, spans: list[tuple[int, int, int]]) -> list[dict]:
    out = []
    for start, end, kind in [*((s, e, k) for s, k, e in spans), *other_tokens(text, spans)]:
        before = text[max(0, start - CONTEXT) : start].lower().split()[-3:]
        after = text[end : end + CONTEXT].lower().split()[:1]
        patterns = ["1 " + ("^", *before)[-1], "2 " + " ".join(("^", "^", *before)[-2:]), "5 " + " ".join(("^", "^", "^", *before)[-3:]), "3 " + (*after, "$")[0], "4 " + text[start:end].translate(_SHAPE)]
        out.append({"patterns": [_code(x) for x in patterns], "instance": _code(text[start:end].lower()), "start": start, "end": end, "kind": kind})
    return out


def find(docs: DataFrame) -> DataFrame:
    """Per row of `docs`: the counts and spans of the rules, and its slots (kinds under 0: unknown)."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slot = pa.list_(pa.struct([("patterns", pa.list_(pa.int64())), ("instance", pa.int64()), ("start", pa.int32()), ("end", pa.int32()), ("kind", pa.int32())]))
        for batch in batches:
            counts, bases, slots = ([], [], [], []), [], []
            for value in batch.column(2):
                text = value.as_py() or ""
                spans = base_spans(text)
                for k in range(4):
                    counts[k].append(sum(x[1] == k for x in spans))
                bases.append(",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans))
                slots.append(_slots(text, spans))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *(pa.array(c, pa.int64()) for c in counts), pa.array(bases, pa.string()), pa.array(slots, slot)], names=[x.split()[0] for x in FOUND.split(", ")[:7]] + ["slots"])

    return docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("t"), "text").mapInArrow(search, FOUND)


def bootstrap(found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(pattern, kind) of the good patterns and (instance, kind) of the instances that became known."""
    slots = found.select(F.explode("slots").alias("s")).select("s.*")
    edges = slots.select(F.explode("patterns").alias("pattern"), "instance", "kind").distinct()
    edges = written(edges, "edges")
    known = written(edges.filter("kind >= 0").groupBy("instance").agg(F.min("kind").alias("known")), "known")
    unknown = edges.filter("kind < 0").select("pattern", "instance").distinct()
    # Parts of what stands as a whole do not speak for or against a pattern.
    both = edges.filter("kind > -2").select("pattern", "instance").distinct()
    while True:
        seen = both.join(known, "instance", "left")
        of_kind = seen.groupBy("pattern", "known").agg(F.count(F.lit(1)).alias("n"))
        total = of_kind.groupBy("pattern").agg(F.sum("n").alias("total"), F.max(F.when(F.col("known").isNotNull(), F.struct("n", (-F.col("known")).alias("k")))).alias("best"))
        confidence = F.col("best.n") / F.col("total")
        good = written(total.filter((F.col("best.n") >= MIN_SUPPORT) & (confidence >= MIN_CONFIDENCE)).select("pattern", (-F.col("best.k")).alias("kind"), F.least(confidence, F.lit(0.99)).alias("confidence")), "patterns")
        score = unknown.join(good, "pattern").groupBy("instance", "kind").agg((1 - F.exp(F.sum(F.log(1 - F.col("confidence"))))).alias("score"))
        passed = score.filter(F.col("score") >= MIN_SCORE).groupBy("instance").agg(F.max(F.struct("score", (-F.col("kind")).alias("k")))["k"].alias("k"))
        new = written(passed.select("instance", (-F.col("k")).alias("known")).join(known, "instance", "left_anti"), "learned")
        if new.isEmpty():
            break
        known = written(known.union(new), "known")
    return good.select("pattern", "kind"), known


def personal_data(docs: DataFrame) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base, spans, n_more, n_spans) of each row: by the rules, by the method, and together."""
    found = written(find(docs), "personal")
    good, known = bootstrap(found)
    slots = found.select("doc_id", "t", F.explode("slots").alias("s")).filter("s.kind < 0").select("doc_id", "t", "s.instance", "s.start", "s.end", F.explode("s.patterns").alias("pattern"))
    seeds = found.select("doc_id", "t", F.explode("slots").alias("s")).filter(F.col("s.kind") >= len(BASE_KINDS)).select("doc_id", "t", "s.start", "s.kind", "s.end")
    more = slots.join(known, "instance").join(good, "pattern").filter(F.col("kind") == F.col("known")).select("doc_id", "t", "start", "kind", "end").union(seeds).distinct()
    # What lies in a longer one that was found is part of it.
    longer = F.max("end").over(Window.partitionBy("doc_id", "t").orderBy("start", F.desc("end"), "kind").rowsBetween(Window.unboundedPreceding, -1))
    same = F.lag(F.struct("start", "end")).over(Window.partitionBy("doc_id", "t").orderBy("start", F.desc("end"), "kind"))
    more = more.withColumns({"longer": longer, "same": same}).filter((F.coalesce("longer", F.lit(-1)) < F.col("end")) | F.coalesce(F.col("same") == F.struct("start", "end"), F.lit(False))).drop("longer", "same")
    more = more.groupBy("doc_id", "t").agg(F.collect_list(F.struct("start", "kind", "end")).alias("more")).withColumnsRenamed({"doc_id": "m_doc_id", "t": "m_t"})
    joined = found.drop("slots").join(more, F.col("doc_id").eqNullSafe(F.col("m_doc_id")) & F.col("t").eqNullSafe(F.col("m_t")), "left")
    parts = F.transform(F.filter(F.split("base", ","), lambda x: x != ""), lambda x: F.struct(F.split(x, ":")[1].cast("int").alias("start"), F.array_position(F.array(*map(F.lit, KINDS)), F.split(x, ":")[0]).cast("int").alias("kind"), F.split(x, ":")[2].cast("int").alias("end")))
    extra = F.transform("more", lambda x: F.struct(x["start"].alias("start"), (x["kind"] + 1).cast("int").alias("kind"), x["end"].alias("end")))
    all_ = F.array_join(F.transform(F.array_sort(F.concat(parts, extra)), lambda x: F.concat_ws(":", F.element_at(F.array(*map(F.lit, KINDS)), x["kind"]), x["start"], x["end"])), ",")
    n_more = F.coalesce(F.size("more"), F.lit(0)).cast("long")
    total = F.col("n_email") + F.col("n_ip") + F.col("n_card") + F.col("n_phone") + n_more
    return joined.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base", F.coalesce(all_, "base").alias("spans"), n_more.alias("n_more"), total.alias("n_spans"))


def op8_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data(documents(spark, sf_dir)).select("doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2(F.col("base").cast("binary"), 256).alias("base_sha256"), "spans", "n_more", "n_spans")
