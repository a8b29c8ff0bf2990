"""Secrets found by patterns and judged by how many owners hold the same value.

Only DataFrame functions are used.  A scan finds the base patterns' spans and further long
mixed runs.  The hashes of all values found are aggregated over the corpus by owner and
repository: a value that several owners hold is a copied example, one that few hold and that
looks random is taken for live.  Runs outside the base patterns become spans only if live.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import staged


def either_case(words: list[str]) -> str:
    return "|".join(
        "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in w) for w in words)


_VALUE = "[A-Za-z0-9+/_.=-]"
_NAMED = (
    f"""({either_case(["password", "passwd", "secret", "token", "api_?key"])})"""
    f"""["']?\\x20*[:=]\\x20*["']?({_VALUE}"""
)


@dataclass(frozen=True)
class Kind:
    """Matches of ``pattern``, leftmost first and apart; ``group`` holds the value, dropped if
    shorter than ``least``.  A text without a match of ``hint`` has none to keep."""

    name: str
    pattern: str
    group: int
    least: int
    hint: str


#: In the order in which kinds are listed; the last one is the method's own.
KINDS = (
    Kind("assign", _NAMED + "+)", 2, 12, _NAMED + "{12})"),
    Kind("access", "AKIA[A-Z0-9]+", 0, 18, "AKIA[A-Z0-9]{14}"),
    Kind("hex", "[0-9a-f]{16,}", 0, 16, "[0-9a-f]{16}"),
    Kind("owned", "[A-Za-z0-9+/_-]{20,}", 0, 20, "[A-Za-z0-9+/_-]{20}"),
)

_SPAN = "array<struct<start:bigint,number:int,end:bigint,value:string>>"


def find(text: Column, number: int, kind: Kind) -> Column:
    """Spans of one kind: start, the kind's number, end (code points, exclusive) and value.

    The text between matches and the matches themselves give the places by their lengths.
    """
    pattern = F.lit(kind.pattern)
    parts = F.arrays_zip(
        F.slice(F.split(text, kind.pattern, -1), 1,
                F.size(F.regexp_extract_all(text, pattern, F.lit(0)))).alias("gap"),
        F.regexp_extract_all(text, pattern, F.lit(0)).alias("match"),
        F.regexp_extract_all(text, pattern, F.lit(kind.group)).alias("value"),
    )
    zero = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast(_SPAN).alias("found"))

    def step(state, part):
        start = state["at"] + F.length(part["gap"])
        end = start + F.length(part["match"])
        span = F.struct(start.cast("bigint").alias("start"), F.lit(number).alias("number"),
                        end.cast("bigint").alias("end"), part["value"].alias("value"))
        return F.struct(
            end.cast("bigint").alias("at"),
            F.when(F.length(part["value"]) >= kind.least,
                   F.concat(state["found"], F.array(span).cast(_SPAN)))
            .otherwise(state["found"]).alias("found"))

    found = F.aggregate(parts, zero, step, lambda state: state["found"])
    return F.when(text.rlike(kind.hint), found).otherwise(F.array().cast(_SPAN))


def mixed(value: Column) -> Column:
    """Looks random: three digits and three letters at least, and eight different characters."""
    digits = F.length(F.regexp_replace(value, "[^0-9]", ""))
    letters = F.length(F.regexp_replace(value, "[^A-Za-z]", ""))
    return (digits >= 3) & (letters >= 3) & (F.size(F.array_distinct(F.split(value, ""))) >= 8)


def scan(docs: DataFrame, owner: str = "source", repository: str = "doc_id",
         example_owners: int = 3) -> DataFrame:
    """For each row of ``docs`` (doc_id, text and the two named columns) its judged spans.

    Columns: key_a, key_b (hashes of doc_id and text), doc_id, spans (array of start, number,
    end, value, verdict; ordered by start, then kind).  ``verdict`` is "example" (held by at least
    ``example_owners`` owners), "live" (fewer, and looking random) or "weak".  Base spans always
    stay; spans of the kind "owned" are those that overlap no base span and are live.  A null
    text is empty; a null owner or repository counts as one of its own; repeated rows give a
    row each and count once per repository; other columns are ignored.
    """
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(
        F.xxhash64("doc_id", "text").alias("key_a"),
        F.xxhash64(F.lit("b"), "text", "doc_id").alias("key_b"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col(owner).cast("string"), F.lit("")).alias("owner"),
        F.coalesce(F.col(repository).cast("string"), F.lit("")).alias("repository"),
        *(find(text, i, kind).alias(kind.name) for i, kind in enumerate(KINDS)),
    )
    base = reduce(F.concat, [F.col(k.name) for k in KINDS[:-1]])
    free = F.filter(
        F.col(KINDS[-1].name),
        lambda x: mixed(x["value"]) & ~F.exists(
            base, lambda b: (b["start"] < x["end"]) & (x["start"] < b["end"])))
    found = staged(
        rows.select("key_a", "key_b", "doc_id", "owner", "repository",
                    F.array_sort(F.concat(base, free)).alias("spans")), "secret-spans")

    candidates = found.where(F.size("spans") > 0).select(
        "key_a", "key_b", "owner", "repository", F.explode("spans").alias("span")
    ).withColumn("value_hash", F.xxhash64("span.value"))
    owners = (
        candidates.select("value_hash", "owner", "repository").distinct()
        .groupBy("value_hash", "owner").agg(F.count(F.lit(1)).alias("repositories"))
        .groupBy("value_hash").agg(F.count(F.lit(1)).alias("owners"),
                                   F.sum("repositories").alias("repositories"))
    )
    verdict = (
        F.when(F.col("owners") >= example_owners, "example")
        .when(mixed(F.col("span.value")), "live").otherwise("weak")
    )
    judged = (
        candidates.join(staged(owners, "secret-owners"), "value_hash")
        .withColumn("verdict", verdict)
        .where((F.col("span.number") < len(KINDS) - 1) | (F.col("verdict") == "live"))
        .select("key_a", "key_b", F.struct(
            "span.start", "span.number", "span.end", "span.value", "verdict").alias("span"))
        .groupBy("key_a", "key_b").agg(F.array_sort(F.collect_set("span")).alias("spans"))
    )
    none = F.array().cast(_SPAN.replace("value:string", "value:string,verdict:string"))
    return (
        found.select("key_a", "key_b", "doc_id").join(judged, ["key_a", "key_b"], "left")
        .withColumn("spans", F.coalesce("spans", none))
    )


def span_text(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    name = lambda x: F.element_at(F.array(*(F.lit(k.name) for k in KINDS)), x["number"] + 1)
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(
        ":", name(x), x["start"].cast("string"), x["end"].cast("string"))), ",")


def masked(docs: DataFrame, owner: str = "source", repository: str = "doc_id",
           mask: str = "[secret]") -> DataFrame:
    """``docs`` with every live value in its text replaced by ``mask``; n_chars follows the text.

    Examples and weak values stay, and so do all rows.  Where a value is live, it is replaced
    wherever it stands in that text.
    """
    live = (
        scan(docs, owner, repository)
        .select("key_a", "key_b", F.array_distinct(F.transform(
            F.filter("spans", lambda x: x["verdict"] == "live"), lambda x: x["value"])).alias("_live"))
        .where(F.size("_live") > 0).dropDuplicates(["key_a", "key_b"])
    )
    longest_first = F.array_sort(
        "_live", lambda a, b: F.when(F.length(a) != F.length(b), F.length(b) - F.length(a))
        .when(a < b, -1).when(a > b, 1).otherwise(0))
    text = F.aggregate(longest_first, F.col("text"), lambda t, v: F.replace(t, v, F.lit(mask)))
    rows = docs.withColumns({"key_a": F.xxhash64("doc_id", "text"),
                             "key_b": F.xxhash64(F.lit("b"), "text", "doc_id")})
    joined = rows.join(live, ["key_a", "key_b"], "left")
    new = F.when(F.col("_live").isNull(), F.col("text")).otherwise(text)
    columns = [new.alias("text") if c == "text"
               else F.coalesce(F.length(new).cast("long"), F.col(c)).alias(c) if c == "n_chars"
               else F.col(c) for c in docs.columns]
    return joined.select(*columns)
