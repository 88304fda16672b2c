"""Secret scan with multipart credential linking, in DataFrame expressions only.

Base findings are assignments to secret names, access identifiers and long hex runs. Weak candidates
(named identifiers, opaque blobs, service addresses) are common in clean text, so they are reported only
if the parts that make them a credential stand near: an identifier near a secret, a blob near an
identifier, an address near both. Nearness is an interval join: spans are dealt to bins as long as the
reach, and spans that share a bin of one text are compared; a bin holds a bounded number of spans.

Findings depend on the text alone. Texts without any are filtered out at once; equal texts are one; rows
find their text's spans by its length and two 64-bit hashes, over stored tables, so that Spark can split
a text that very many rows share.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.runtime import materialise

REACH = 256


@dataclass(frozen=True)
class Kind:
    """``least`` is on the length of ``group``; ``also`` are patterns that a match must hold as well."""

    name: str
    pattern: str
    part: str
    base: bool
    group: int = 0
    least: int = 1
    also: tuple[str, ...] = ()


KINDS = (
    Kind("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", "secret", True, 2, 12),
    Kind("access", r"AKIA[A-Z0-9]+", "id", True, 0, 18),
    Kind("hex", r"[0-9a-f]{16,}", "secret", True, 0, 16),
    Kind("id", r"""(?i:access_?key_?id|client_?id|key_?id|account|username|login)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.@-]{4,}""", "id", False),
    Kind("blob", r"[A-Za-z0-9+/]{32,}={0,2}", "secret", False, 0, 32, ("[0-9]", "[A-Z]", "[a-z]")),
    Kind("address", r"""(?:https?|ftp|s3|gs|postgres|postgresql|mysql|mongodb|redis|amqp)://[^\x20\x09-\x0D"'<>]{4,}""", "endpoint", False),
)
#: For each part of a weak candidate, the parts that must stand near.
COMPLEMENTS = {"id": ("secret",), "secret": ("id",), "endpoint": ("id", "secret")}
KEY = ["_h1", "_h2", "_n"]


def _text_key(text: Column) -> list[Column]:
    return [F.xxhash64(text).alias("_h1"), F.xxhash64(F.lit(1), text).alias("_h2"), F.length(text).alias("_n")]


def _matches(text: Column, kind: Kind) -> Column:
    """Array of (before, match, value): code points since the last match, and the strings matched.

    The text split at the pattern has one part before each match, none of which is empty-width."""
    pattern = F.lit(kind.pattern)
    before = F.transform(F.split(text, kind.pattern), lambda part: F.length(part))
    found = F.arrays_zip(
        before.alias("before"), F.regexp_extract_all(text, pattern, F.lit(0)).alias("match"), F.regexp_extract_all(text, pattern, F.lit(kind.group)).alias("value")
    )
    return F.filter(found, lambda m: m["match"].isNotNull())


def find_spans(texts: DataFrame, text: str, kinds: tuple[Kind, ...] = KINDS) -> DataFrame:
    """(key of the text, kind, part, base, start, end) of all matches that hold their kind's conditions."""
    column = F.col(text)
    some = texts.where(reduce(lambda a, b: a | b, [column.rlike(k.pattern) for k in kinds]))
    hits = some.select(*_text_key(column), *[F.when(column.rlike(k.pattern), _matches(column, k)).alias(k.name) for k in kinds])
    hits = materialise(hits.dropDuplicates(KEY), "secret-hits")
    spans = None
    for at, k in enumerate(kinds):
        rows = hits.select(*KEY, F.posexplode(k.name).alias("pos", "m")).select(*KEY, "pos", "m.*")
        upto = Window.partitionBy(*KEY).orderBy("pos")
        start = F.sum(F.col("before") + F.length("match")).over(upto) - F.length("match")
        rows = rows.withColumns({"start": start, "end": start + F.length("match")})
        keep = F.length("value") >= k.least
        for pattern in k.also:
            keep = keep & F.col("match").rlike(pattern)
        rows = rows.where(keep).select(
            *KEY, F.lit(k.name).alias("kind"), F.lit(at).alias("place"), F.lit(k.part).alias("part"), F.lit(k.base).alias("base"), F.col("start").cast("long"), F.col("end").cast("long")
        )
        spans = rows if spans is None else spans.unionByName(rows)
    return spans


def link_parts(spans: DataFrame, reach: int = REACH) -> DataFrame:
    """Base spans, and the weak ones whose complements stand within ``reach`` code points.

    A weak span that overlaps a base one is covered by it and not reported."""
    spans = materialise(spans, "secret-spans")
    bins = lambda lo, hi: F.explode(F.sequence(F.floor(lo / reach), F.floor(hi / reach)))
    weak = spans.where(~F.col("base")).withColumn("bin", bins(F.col("start") - reach, F.col("end") + reach))
    near = spans.select(*KEY, F.col("part").alias("o_part"), F.col("base").alias("o_base"), F.col("start").alias("o_start"), F.col("end").alias("o_end"))
    near = near.withColumn("bin", bins(F.col("o_start"), F.col("o_end")))
    pairs = weak.join(near, [*KEY, "bin"]).where((F.col("o_start") - F.col("end") <= reach) & (F.col("start") - F.col("o_end") <= reach))
    overlap = (F.col("o_start") < F.col("end")) & (F.col("start") < F.col("o_end"))
    sums = [F.max((F.col("o_part") == p) & ~overlap).alias(p) for p in ("id", "secret")] + [F.max(F.col("o_base") & overlap).alias("covered")]
    judged = pairs.groupBy(*KEY, "kind", "place", "part", "start", "end").agg(*sums)
    complete = F.lit(False)
    for part, others in COMPLEMENTS.items():
        complete = complete | ((F.col("part") == part) & reduce(lambda a, b: a & b, [F.col(o) for o in others]))
    linked = judged.where(complete & ~F.col("covered")).withColumn("base", F.lit(False))
    columns = [*KEY, "kind", "place", "base", "start", "end"]
    return spans.where("base").select(*columns).unionByName(linked.select(*columns))


def scan_secrets(docs: DataFrame, text: str = "text", result: str = "secrets", reach: int = REACH) -> DataFrame:
    """``docs`` with an array ``result`` of (kind, start, end, base), ordered by start, then kind.

    Positions count code points, the end excluded. A null or empty text has an empty array. Rows are
    found by their text, so null ids and repeated rows need no rule; other columns pass through, one named
    ``result`` is replaced.
    """
    docs = docs.drop(result, *KEY)
    linked = link_parts(find_spans(docs.select(F.col(text).alias("text")), "text"), reach)
    one = F.struct("start", "place", "kind", "end", "base")
    lists = linked.groupBy(*KEY).agg(F.array_sort(F.collect_list(one)).alias("found"))
    lists = materialise(lists, "secret-lists")
    keyed = docs.withColumns({"_h1": F.xxhash64(text), "_h2": F.xxhash64(F.lit(1), F.col(text)), "_n": F.length(text)})
    joined = keyed.join(lists, KEY, "left")
    listed = F.transform("found", lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["base"].alias("base")))
    empty = F.array().cast("array<struct<kind:string,start:bigint,end:bigint,base:boolean>>")
    columns = [F.col(f"`{c}`") for c in docs.columns]
    return joined.select(*columns, F.coalesce(listed, empty).alias(result))


def span_text(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
