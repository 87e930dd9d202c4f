"""Canonical exact document fingerprints, with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from docloom.llm.workspace import Workspace

#: Rows of a range of neighbours, about; FAN ranges are cut in up to FAN each.
ROWS_PER_RANGE = 1024
FAN = 1024
_LAST = (1 << 63) - 1


def canonical(text: Column) -> Column:
    """NFKC, full case folding, NFKC again; runs of white space are one space, none at the ends. Null is empty.

    The JVM's ICU does it; ASCII texts need lower() only, with the same result.
    """
    text = F.coalesce(text, F.lit(""))
    compose = lambda x: F.reflect(F.lit("com.ibm.icu.text.Normalizer"), F.lit("compose"), x, F.lit(True))
    folded = compose(F.reflect(F.lit("com.ibm.icu.lang.UCharacter"), F.lit("foldCase"), compose(text), F.lit(True)))
    plain = F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(folded)
    return F.trim(F.regexp_replace(plain, r"[\s\x1c-\x1f\x85\p{Z}]+", " "))


def hashes(canon: str) -> list[Column]:
    """Two 64-bit xxhashes of a canonical text under different seeds."""
    return [F.xxhash64(F.lit(seed), canon) for seed in (0x51, 0xC7)]


def hashed(rows: DataFrame, text_col: str, a: str, b: str, keep: str | None = None) -> DataFrame:
    """rows with the hashes a and b of a text; the canonical text is worked out once, and kept under the name keep."""
    canon = keep or f"{a}__canon"
    first, second = hashes(canon)
    out = rows.withColumn(canon, canonical(F.col(text_col))).withColumn(a, first).withColumn(b, second)
    return out if keep else out.drop(canon)


def fingerprint(a: str, b: str) -> Column:
    """128 bits as 32 hex digits."""
    return F.concat(*(F.lpad(F.lower(F.hex(F.col(x))), 16, "0") for x in (a, b)))


def exact_groups(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(a, b, digest, group_id, n_rows) of each distinct canonical text; a and b are its hashes.

    The grouping's key holds the canonical text itself, so that equal hashes are compared
    by their bytes. Copies are combined before the shuffle: a group of any size is one row
    a task. digest (SHA-256 of the canonical text) tells texts of equal hashes apart.
    group_id is the smallest id, null if all are.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("t"))
    same = hashed(rows, "t", "a", "b", keep="c").groupBy("a", "b", "c").agg(F.min("id").alias("group_id"), F.count("*").alias("n_rows"))
    return same.select("a", "b", F.unhex(F.sha2("c", 256)).alias("digest"), "group_id", "n_rows")


def _place(cuts: Column, most: int, x: Column) -> Column:
    """The last of ascending cuts (at most so many) that is not above x, by binary search; the first cut is below all x."""
    steps = F.array(*(F.lit(1 << k) for k in reversed(range(max(1, most.bit_length())))))
    go = lambda at, step: F.when((at + step <= F.size(cuts)) & (F.get(cuts, at + step - 1) <= x), at + step).otherwise(at)
    return F.aggregate(steps, F.lit(0), go) - 1


def ranged(rows: DataFrame, key: str, tie: str) -> DataFrame:
    """rows with range, before (the range before it, in a circle) and starts (whether the row may be the first of its range).

    Ranges hold about ROWS_PER_RANGE rows. FAN quantiles of key make coarse ranges, one of
    its own for a key that fills more than one quantile; each coarse range is cut in up to
    FAN by quantiles of key, or of tie where it has one key. Only the coarse quantiles (FAN
    numbers) come to the driver; a table of FAN rows of FAN numbers at most is broadcast.
    """
    size = rows.agg(F.count("*").alias("n"), F.min(key).alias("least")).first()
    n = min(FAN, max(1, -(-size.n // ROWS_PER_RANGE)))
    found = rows.agg(F.percentile_approx(key, [i / n for i in range(1, n)], 10 * FAN).alias("q")).first().q if n > 1 else []
    single = {v for v, w in zip(found, found[1:]) if v == w}
    cuts = sorted({size.least or 0, *found, *(v + 1 for v in single if v < _LAST)})
    bucket = _place(F.array(*(F.lit(c).cast("bigint") for c in cuts)), len(cuts), F.col(key))
    fine = F.when(F.col(key).isin(*single), F.col(tie)).otherwise(F.col(key)) if single else F.col(key)
    rows = rows.withColumn("bucket", bucket).withColumn("fine", fine)
    tall = rows.groupBy("bucket").count().agg(F.max("count").alias("n")).first().n or 0
    m = min(FAN, max(1, -(-tall // (2 * ROWS_PER_RANGE))))
    inner = F.percentile_approx("fine", [i / m for i in range(1, m)], 10 * FAN) if m > 1 else F.array().cast("array<bigint>")
    parts = rows.groupBy("bucket").agg(F.count("*").alias("n"), F.min("fine").alias("least"), inner.alias("q"))
    stride = F.greatest(F.lit(1), F.floor(F.lit(m) / F.greatest(F.lit(1), F.ceil(F.col("n") / (2 * ROWS_PER_RANGE))))).cast("int")
    parts = parts.withColumn("stride", stride)
    parts = parts.select("bucket", F.array_sort(F.array_union(F.array("least"), F.filter("q", lambda x, i: (i + 1) % F.col("stride") == 0))).alias("cuts"))
    order = Window.orderBy("bucket")
    last = F.struct("bucket", F.size("cuts").alias("n"))
    parts = parts.withColumn("prev", F.coalesce(F.lag(last).over(order), F.last(last).over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))))
    placed = rows.join(F.broadcast(parts), "bucket").withColumn("j", _place(F.col("cuts"), FAN, F.col("fine")))
    number = lambda b, j: b.cast("bigint") * (2 * FAN) + j
    placed = placed.withColumn("range", number(F.col("bucket"), F.col("j")))
    placed = placed.withColumn("before", F.when(F.col("j") > 0, F.col("range") - 1).otherwise(number(F.col("prev.bucket"), F.col("prev.n") - 1)))
    return placed.withColumn("starts", F.col("fine") == F.get("cuts", F.col("j"))).drop("bucket", "fine", "cuts", "prev", "j")


def with_next(rows: DataFrame) -> DataFrame:
    """rows (id, text, a, b, key, tie, row) with next_text, next_a, next_b of the next row; the last row's next is the first.

    Rows are ordered by key, tie and row. The first row of each range is also sent to the
    range before it, so that a window within each range sees every neighbour.
    """
    placed = ranged(rows, "key", "tie")
    maybe = placed.filter("starts")
    firsts = maybe.groupBy("range").agg(F.min(F.struct("key", "tie", "row")).getField("row").alias("row")).select("row")
    columns = ["id", "text", "a", "b", "key", "tie", "row"]
    dealt = placed.select(*columns, "range", F.lit(0).alias("ghost")).unionByName(maybe.join(firsts, "row").select(*columns, F.col("before").alias("range"), F.lit(1).alias("ghost")))
    order = Window.partitionBy("range").orderBy("ghost", "key", "tie", "row")
    following = [F.lead(c).over(order).alias(f"next_{c}") for c in ("text", "a", "b")]
    return dealt.select(*columns, "ghost", *following).filter("ghost = 0").drop("ghost")


def fingerprint_documents(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of each row's text, of an edited text, and how alike they are.

    Columns: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next, group_doc_id (smallest id of the rows with the same canonical text, null if
    all are null). The edited text has the last floor(n_chars / 2) code points replaced by
    the first as many of the next row's text. Likeness of exact fingerprints is 1 or 0;
    equal ones were compared by their canonical bytes, and texts that differ never share a
    group, even under one fingerprint.

    Null texts count as empty and are alike. Null ids come after all others; rows of one id
    are ordered by a hash of their texts; repeated rows stay, and those of one id and text
    share a range. Texts of any length are read whole; a single row is its own next; an
    empty table gives no rows. Other columns are not read, whatever their names.
    """
    ws = Workspace(docs.sparkSession, "fingerprints")
    groups = ws.write(exact_groups(docs, id_col=id_col, text_col=text_col), "groups")
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    rows = hashed(rows, "text", "a", "b").withColumn("key", F.coalesce("id", F.lit(_LAST))).withColumn("tie", F.xxhash64("text")).withColumn("row", F.monotonically_increasing_id())
    rows = with_next(ws.write(rows, "rows"))

    half = F.floor(F.length("text") / 2).cast("int")
    rows = rows.withColumn("edited", F.concat(F.left("text", F.length("text") - half), F.left("next_text", half)))
    rows = hashed(rows, "edited", "ea", "eb")
    alike = lambda a, b, text: F.when((F.col("a") == F.col(a)) & (F.col("b") == F.col(b)), (canonical(F.col("text")) == canonical(F.col(text))).cast("double")).otherwise(F.lit(0.0))
    found = rows.select(
        F.col("id").alias("doc_id"),
        F.length("text").cast("bigint").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        fingerprint("a", "b").alias("fingerprint"),
        fingerprint("ea", "eb").alias("edited_fingerprint"),
        alike("ea", "eb", "edited").alias("near_edited"),
        alike("next_a", "next_b", "next_text").alias("near_next"),
        "a",
        "b",
        "text",
    )
    keys = ["a", "b"]
    if not groups.groupBy(*keys).count().filter("count > 1").isEmpty():  # different texts under one fingerprint
        found, keys = found.withColumn("digest", canonical(F.col("text"))).withColumn("digest", F.unhex(F.sha2("digest", 256))), [*keys, "digest"]
    found = found.drop("text")
    return found.join(groups.select(*keys, F.col("group_id").alias("group_doc_id")), keys).drop(*keys)
