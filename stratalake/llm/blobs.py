"""Secret scans with a ledger of blobs: each text is scanned once by each version of a rule, and findings go back to every path that holds it.

A version of a document is addressed by the sha256 of its text. The ledger, a Parquet folder, has what was scanned: (blob, scanned pairs of
rule and rule version, found spans). A scan takes the distinct blobs of all versions that it is given, looks up which pairs the ledger lacks, carries
only the texts of those blobs, once each, to the tasks, and appends what they find; a rule with a new version is run alone. Copies
are dropped where they are read, before anything is shuffled. Findings are then joined to all paths and versions by the blob's address.

Defined results: a null text is empty and has the empty text's blob; spans count code points and their ends are exclusive; spans of different kinds may
overlap; repeated rows get the same findings; a null id is kept; other columns are carried by `findings`, whatever their names; a very long text is
scanned as a whole, in time in proportion to its length; an empty table gives an empty result and leaves the ledger as it is.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.llm.tables import documents, shared_folder, small, written


@dataclass(frozen=True)
class Rule:
    """Matches of `pattern` are findings if their group `group` has at least `least` characters; a change needs a new `version`."""

    name: str
    version: int
    pattern: str
    group: int = 0
    least: int = 0
    compiled: re.Pattern = field(init=False, compare=False, repr=False)

    def __post_init__(self):
        object.__setattr__(self, "compiled", re.compile(self.pattern, re.ASCII))

    def spans(self, text: str) -> Iterator[tuple[int, int]]:
        for m in self.compiled.finditer(text):
            start, end = m.span(self.group)
            if end - start >= self.least:
                yield m.span()


def _either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


_NAMES = "|".join(map(_either_case, ("password", "passwd", "secret", "token", "api_?key")))
#: The fixed rules; runs of a set of characters are matched from their least length on, as a shorter run has no longer match in it.
BASE_RULES = (
    Rule("assign", 1, rf"""({_NAMES})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", 1, "AKIA[A-Z0-9]{16,}"),
    Rule("hex", 1, "[0-9a-f]{24,}"),
)
#: What the scan adds: headers of private keys, signed web tokens, tokens of known services, passwords in addresses.
MORE_RULES = (
    Rule("private_key", 1, "-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"),
    Rule("web_token", 1, r"eyJ[A-Za-z0-9_-]{8,900}\.eyJ[A-Za-z0-9_-]{8,900}\.[A-Za-z0-9_-]{8,900}"),
    Rule("service_token", 1, "gh[opsu]_[A-Za-z0-9]{36,}|xox[abprs]-[A-Za-z0-9-]{10,}|sk_live_[A-Za-z0-9]{16,}"),
    Rule("url_password", 1, r"://[A-Za-z0-9._-]{1,64}:[A-Za-z0-9._~!$&*+=-]{3,64}@"),
)
RULES = (*BASE_RULES, *MORE_RULES)
_PAIR, _FOUND = "struct<rule:string,version:int>", "struct<rule:string,version:int,start:int,end:int>"
LEDGER = f"blob string, scanned array<{_PAIR}>, found array<{_FOUND}>"


def new_ledger(spark: SparkSession, path: str) -> str:
    """An empty ledger at `path`."""
    spark.createDataFrame([], LEDGER).write.parquet(path)
    return path


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(LEDGER).parquet(path)


def address(text: Column) -> Column:
    """The content address of a text."""
    return F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256)


def _first_copies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first row of each blob of a partition."""
    seen: set[bytes] = set()
    for batch in batches:
        keep = []
        for b in batch.column(0).to_pylist():
            keep.append((key := bytes.fromhex(b)) not in seen)
            seen.add(key)
        yield batch.filter(pa.array(keep, pa.bool_()))


def _scanner(rules: tuple[Rule, ...]):
    pair = pa.struct([("rule", pa.string()), ("version", pa.int32())])
    span = pa.struct([("rule", pa.string()), ("version", pa.int32()), ("start", pa.int32()), ("end", pa.int32())])
    known = {(r.name, r.version): r for r in rules}

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _first_copies(batches):
            found = []
            for text, missing in zip(batch.column(1), batch.column(2).to_pylist()):
                text = text.as_py() or ""
                found.append([{"rule": p["rule"], "version": p["version"], "start": s, "end": e} for p in missing for s, e in known[p["rule"], p["version"]].spans(text)])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2).cast(pa.list_(pair)), pa.array(found, pa.list_(span))], names=["blob", "scanned", "found"])

    return scan


def scan(versions: DataFrame, text: str, ledger: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Bring the ledger at `ledger` up to date with the texts of `versions`; returns (blob, missing): what this scan had to look at, and by which rules."""
    spark = versions.sparkSession
    wanted = F.array(*[F.struct(F.lit(r.name).alias("rule"), F.lit(r.version).alias("version")) for r in rules])
    rows = versions.select(address(versions[text]).alias("blob"), F.coalesce(versions[text], F.lit("")).alias("text"))
    done = read_ledger(spark, ledger).groupBy("blob").agg(F.flatten(F.collect_list("scanned")).alias("done"))  # a pair is scanned once
    missing = rows.select("blob").distinct().join(done, "blob", "left")
    missing = written(missing.select("blob", F.array_except(wanted, F.coalesce("done", F.array().cast(f"array<{_PAIR}>"))).alias("missing")).filter(F.size("missing") > 0), "unseen-blobs")
    if missing.isEmpty():
        return missing
    few = small(missing)  # most scans see few new blobs: then no other text leaves its task
    texts = rows.mapInArrow(_first_copies, "blob string, text string")
    # Dealt by blob after the copies of each task are gone, so that one task sees all that is left of a blob.
    texts = texts.join(few, "blob", "left_semi").repartition("blob").join(missing.hint("shuffle_hash"), "blob").select("blob", "text", "missing")
    texts.mapInArrow(_scanner(rules), LEDGER).write.mode("append").parquet(ledger)
    return missing


def findings(versions: DataFrame, text: str, ledger: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """`versions` with blob and found, the spans of the given rules in the ledger, by start, then rule as listed; every version of every path has those of its text."""
    order = {r.name: i for i, r in enumerate(rules)}
    current = F.array(*[F.struct(F.lit(r.name).alias("rule"), F.lit(r.version).alias("version")) for r in rules])
    kept = F.filter("found", lambda x: F.array_contains(current, F.struct(x["rule"].alias("rule"), x["version"].alias("version"))))
    place = lambda x: F.element_at(F.create_map(*[v for k, i in order.items() for v in (F.lit(k), F.lit(i))]), x["rule"])
    ordered = F.transform(F.array_sort(F.transform(kept, lambda x: F.struct(x["start"].alias("start"), place(x).alias("kind"), x["end"].alias("end"), x["rule"].alias("rule")))), lambda x: F.struct(x["rule"], x["start"], x["end"]))
    known = read_ledger(versions.sparkSession, ledger).groupBy(F.col("blob").alias("l_blob")).agg(F.flatten(F.collect_list("found")).alias("found"))
    # Written, so that Spark can split a hot blob in the join below.
    known = written(known.select("l_blob", ordered.alias("l_found")).filter(F.size("l_found") > 0), "blob-findings")
    rows = versions.select(F.struct(*[versions[c] for c in versions.columns if c != text]).alias("row"), address(versions[text]).alias("blob"))
    none = F.array().cast("array<struct<rule:string,start:int,end:int>>")
    return rows.join(known, F.col("blob") == F.col("l_blob"), "left").select("row.*", "blob", F.coalesce("l_found", none).alias("found"))


def op13_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    ledger = new_ledger(spark, f"{shared_folder(spark)}/blob-ledger-{uuid.uuid4().hex}")
    scan(docs, "text", ledger)
    names = [r.name for r in BASE_RULES]
    listed = lambda spans: F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["rule"], x["start"], x["end"])), ",")
    base = F.filter("found", lambda x: x["rule"].isin(names))
    of = lambda k: F.size(F.filter("found", lambda x: x["rule"] == k)).cast("long")
    counts = [of(k).alias(f"n_{k}") for k in names]
    return findings(docs, "text", ledger).select("doc_id", *counts, F.sha2(listed(base).cast("binary"), 256).alias("base_sha256"), listed(F.col("found")).alias("spans"), "blob")


def _located(k: int, rule: Rule) -> str:
    """SQL for (doc_id, k, rule, s, e): matches of a rule are placed by the lengths of what lies between them."""
    pattern = rule.pattern.replace("'", "''")
    return f"""select doc_id, {k} as k, '{rule.name}' as rule, s, s + length(m[i]) as e from (
        select *, (list_sum(list_transform(p[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0))::bigint as s from (
            select *, unnest(range(1, len(m) + 1)) as i from (select doc_id, regexp_extract_all(text, '{pattern}') as m, regexp_extract_all(text, '{pattern}', {rule.group}) as g, regexp_split_to_array(text, '{pattern}') as p from documents) a) b
        ) c where length(g[i]) >= {rule.least}"""


OP13_SQL = f"""
with f as ({" union all ".join(_located(k, r) for k, r in enumerate(RULES))}),
g as (select doc_id, {", ".join(f"count(*) filter (where rule = '{r.name}') as n_{r.name}" for r in BASE_RULES)},
    string_agg(rule || ':' || s || ':' || e, ',' order by s, k) filter (where k < {len(BASE_RULES)}) as base, string_agg(rule || ':' || s || ':' || e, ',' order by s, k) as spans from f group by 1)
select d.doc_id, {", ".join(f"coalesce(n_{r.name}, 0)::bigint as n_{r.name}" for r in BASE_RULES)}, sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans, sha256(coalesce(d.text, '')) as blob
from documents d left join g on g.doc_id = d.doc_id
"""
