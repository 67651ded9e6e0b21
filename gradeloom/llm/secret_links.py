"""Secret scans with multipart credential linking.

Three base kinds are found by pattern. Weaker parts, which alone mean nothing, are access
identifiers (short key ids, user and client names), short assigned secrets, and endpoints
(URLs, hosts). A weak part is reported only when what completes it stands within
``reach`` characters of the same text: an identifier needs a secret, a secret needs an
identifier or an endpoint, an endpoint needs both. The join of parts by interval goes
through buckets of ``reach`` characters that keep, per role, the first and last start:
rows stay in proportion to the parts, however many stand together.

A null text counts as empty. Every row, repeated ones too, gets its own result row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gradeloom.llm.common import stored

REACH = 240

# The base patterns and their least lengths.
ASSIGN = (
    r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
    r"[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{16,}"
ASSIGN_LEAST, ACCESS_LEAST = 12, 18

# Weak parts of credentials.
NAME = r"(?:[Uu][Ss][Ee][Rr](?:[Nn][Aa][Mm][Ee])?|[Ll][Oo][Gg][Ii][Nn]|[Cc][Ll][Ii][Ee][Nn][Tt]_?[Ii][Dd])[\"']?\x20*[:=]\x20*[\"']?[A-Za-z0-9_.@-]{3,}"
ENDPOINT = r"(?:https?|ftp|jdbc:[a-z]+|postgres(?:ql)?|mysql|mongodb|redis|amqp)://[^\x20\x09-\x0D\"'<>]+|[Hh][Oo][Ss][Tt]\x20*[:=]\x20*[A-Za-z0-9.-]{3,}"
WEAK_ASSIGN_LEAST, WEAK_ACCESS_LEAST = 4, 12

_KINDS = ("assign", "access", "hex", "link_id", "link_secret", "link_endpoint")


def _matches(text: Column, pattern: str, group: int | None = None) -> Column:
    """Matches as (gap before, length, length of a group); what lies between has one entry more."""
    between = F.split(text, pattern, -1)
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    n = F.size(found)
    gaps = F.slice(between, F.lit(1), n)
    paired = F.zip_with(gaps, found, lambda g, m: F.struct(F.length(g).alias("gap"), F.length(m).alias("len")))
    if group is None:
        return F.transform(paired, lambda x: F.struct(x["gap"].alias("gap"), x["len"].alias("len"), x["len"].alias("core")))
    inner = F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    return F.zip_with(
        paired, inner, lambda x, y: F.struct(x["gap"].alias("gap"), x["len"].alias("len"), F.length(y).alias("core"))
    )


def _parts(found: DataFrame) -> DataFrame:
    """One row per part: rid, kind, start, end."""

    def labelled(kind: str) -> Column:
        return F.transform(
            kind, lambda x, i: F.struct(F.lit(kind).alias("found"), i.alias("i"), x["gap"].alias("gap"), x["len"].alias("len"), x["core"].alias("core"))
        )

    pieces = F.concat(*[labelled(kind) for kind in ("assign", "access", "hex", "name", "endpoint")])
    rows = found.select("rid", F.inline(pieces))
    upto = Window.partitionBy("rid", "found").orderBy("i")
    placed = rows.withColumn("end", F.sum(F.col("gap").cast("long") + F.col("len")).over(upto)).withColumn("start", F.col("end") - F.col("len"))
    kind, core = F.col("found"), F.col("core")
    named = (
        F.when(kind == "hex", "hex")
        .when((kind == "assign") & (core >= ASSIGN_LEAST), "assign")
        .when((kind == "access") & (core >= ACCESS_LEAST), "access")
        .when((kind == "assign") & (core >= WEAK_ASSIGN_LEAST), "link_secret")
        .when(((kind == "access") & (core >= WEAK_ACCESS_LEAST)) | (kind == "name"), "link_id")
        .when(kind == "endpoint", "link_endpoint")
    )
    return placed.select("rid", named.alias("kind"), "start", "end").where(F.col("kind").isNotNull())


def _linked(parts: DataFrame, reach: int) -> DataFrame:
    """The weak parts that what completes them stands close to."""
    kind = F.col("kind")
    role = (
        F.when(kind.isin("access", "link_id"), "id").when(kind == "link_endpoint", "endpoint").otherwise("secret")
    )
    bucket = F.expr(f"start div {reach}")
    present = (
        parts.groupBy("rid", bucket.alias("bucket"), role.alias("role")).agg(F.min("start").alias("first"), F.max("start").alias("last"))
    )
    weak = parts.where(kind.startswith("link_")).select(
        "rid", "kind", "start", "end", bucket.alias("own"), F.explode(F.array(bucket - 1, bucket, bucket + 1)).alias("bucket")
    )
    near = (
        F.when(F.col("bucket") < F.col("own"), F.col("start") - F.col("last") <= reach)
        .when(F.col("bucket") > F.col("own"), F.col("first") - F.col("start") <= reach)
        .otherwise(True)
    )
    met = weak.join(present, ["rid", "bucket"]).where(near)
    has = {r: F.max(F.col("role") == r).alias(r) for r in ("id", "secret", "endpoint")}
    seen = met.groupBy("rid", "kind", "start", "end").agg(*has.values())
    completed = (
        F.when(kind == "link_id", F.col("secret"))
        .when(kind == "link_secret", F.col("id") | F.col("endpoint"))
        .otherwise(F.col("id") & F.col("secret"))
    )
    return seen.where(completed).select("rid", "kind", "start", "end")


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", reach: int = REACH) -> DataFrame:
    """Per row: doc_id and ``spans``, an array of (start, order, kind, end) in order."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    source = docs.select(F.col(id_col).alias("doc_id"), text.alias("t"))
    found = source.select(
        "doc_id",
        F.monotonically_increasing_id().alias("rid"),
        _matches(F.col("t"), ASSIGN, 2).alias("assign"),
        _matches(F.col("t"), ACCESS).alias("access"),
        _matches(F.col("t"), HEX).alias("hex"),
        _matches(F.col("t"), NAME).alias("name"),
        _matches(F.col("t"), ENDPOINT).alias("endpoint"),
    )
    found = stored(found, "secrets-found")
    any_part = F.size("assign") + F.size("access") + F.size("hex") + F.size("name") + F.size("endpoint") > 0
    parts = stored(_parts(found.where(any_part)), "secrets-parts")
    kept = parts.where(~F.col("kind").startswith("link_")).unionByName(_linked(parts, reach))
    order = F.array_position(F.array(*[F.lit(k) for k in _KINDS]), F.col("kind"))
    spans = kept.groupBy("rid").agg(
        F.array_sort(F.collect_list(F.struct("start", order.cast("int").alias("order"), "kind", "end"))).alias("spans")
    )
    joined = found.select("doc_id", "rid").join(spans, "rid", "left")
    empty = F.array().cast(spans.schema["spans"].dataType)
    return joined.select("doc_id", F.coalesce("spans", empty).alias("spans"))


def digest(spans: DataFrame) -> DataFrame:
    """Counts of the base kinds, a digest of the base spans and all spans as text."""

    def listed(column: Column) -> Column:
        return F.array_join(F.transform(column, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    base = F.filter("spans", lambda s: ~s["kind"].startswith("link_"))

    def counted(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [counted(kind) for kind in _KINDS[:3]]
    return spans.select(
        "doc_id", *counts, F.sha2(listed(base).cast("binary"), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans")
    )
