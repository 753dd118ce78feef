"""Document fingerprints by consistent weighted sampling.

A text's terms are its words (maximal runs of code points other than 0x20 and 0x09-0x0D, lower-cased) weighted by how often
they occur. For each sample k and term, hashes of the pair give r and c, both gamma distributed with shape 2, and b,
uniform. With t = floor(ln(weight) / r + b), the term's value is ln c - r * (t - b + 1); the term of least value and its t
are the sample. Two texts have the same sample with a probability equal to their generalised Jaccard similarity, the sum
of smaller weights over the sum of larger ones. A fingerprint is ``SAMPLES`` samples, each as 24 bits of a hash of
term and t; likeness is the share of equal samples, with a standard error of at most 0.5 / sqrt(SAMPLES).

All of it is DataFrame functions. A value and its sample's bits share one long (value in the upper 40 bits), so that the
samples of a text are plain minimums with partial aggregation.

Cases: a null or empty text has no terms: its fingerprint is all zeros, alike (1) to another such and to no other (0).
Texts of any length count whole. Equal texts get equal fingerprints. Extra columns are not read. Rows that repeat
identifier and text count once as neighbours and are all returned; rows with one identifier are ordered by a hash of
their texts; a null identifier comes first. With a single document the next one is itself. Empty tables give empty tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut

SAMPLES = 64
_BITS = 24
_NULL_ID = -(1 << 63)


def words(text: Column) -> Column:
    return F.split(F.lower(text), "[\\x20\\x09-\\x0D]+")


def _product(bits: Column) -> Column:
    """Product of two uniforms in (0, 1), of 26 bits of a hash each."""
    part = lambda x: x.bitwiseAND(F.lit((1 << 26) - 1)) + F.lit(0.5)
    return part(bits) * part(F.shiftrightunsigned(bits, 26)) * F.lit(2.0**-52)


def salt(k: int) -> int:
    """What a term's hash is mixed with for sample ``k``, as a signed long."""
    x = (k + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1
    return x - (1 << 64) if x >> 63 else x


def _sample(term: Column, log_weight: Column, k: int) -> Column:
    """One term's value and sample bits for sample ``k`` in one long."""
    one = F.xxhash64(term.bitwiseXOR(F.lit(salt(k))))
    two = F.xxhash64(one)
    less_r, less_c = F.ln(_product(one)), F.ln(_product(two))  # -r and -c
    b = (F.shiftrightunsigned(two, 52) + F.lit(0.5)) * F.lit(2.0**-12)
    t = F.floor(b - log_weight / less_r)
    value = F.ln(-less_c) + less_r * (t - b + F.lit(1.0))
    # r and c are in (0, 38) and c is above 2**-54, so the value is between -160 and 4 for any weight a long holds
    upper = F.floor((value + F.lit(400.0)) * F.lit(float(1 << 30)))
    own = one.bitwiseXOR(t * F.lit(0x9E3779))
    return F.shiftleft(upper, _BITS).bitwiseOR(own.bitwiseAND(F.lit((1 << _BITS) - 1)))


def sketches(terms: DataFrame, keys: list[str], samples: int = SAMPLES) -> DataFrame:
    """terms: ``keys``, term (long), weight. One row for each key: s0, s1 ..., the least value of each sample."""
    at = terms.withColumn("log_weight", F.ln(F.col("weight").cast("double")))
    return at.groupBy(*keys).agg(*[F.min(_sample(F.col("term"), F.col("log_weight"), k)).alias(f"s{k}") for k in range(samples)])


def as_text(columns: list[Column]) -> Column:
    return F.concat(*[F.lpad(F.lower(F.hex(c.bitwiseAND(F.lit((1 << _BITS) - 1)))), _BITS // 4, "0") for c in columns])


def likeness(a: Column, b: Column, samples: int = SAMPLES) -> Column:
    """Share of equal samples of two fingerprints as bytes."""
    n = _BITS // 8
    same = F.lit(0)
    for k in range(samples):
        same = same + (F.substring(a, k * n + 1, n) == F.substring(b, k * n + 1, n)).cast("int")
    return same / float(samples)


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", samples: int = SAMPLES) -> DataFrame:
    """``id_col`` and fingerprint of every row; for equal identifiers the texts tell rows apart."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    keyed = df.select(F.col(id_col), F.xxhash64(text).alias("h"), text.alias("text"))
    terms = keyed.select(id_col, "h", F.explode(words(F.col("text"))).alias("word")).where("word <> ''")
    counted = terms.groupBy(id_col, "h", F.xxhash64("word").alias("term")).agg(F.count("*").alias("weight"))
    made = sketches(counted, [id_col, "h"], samples).select(id_col, "h", as_text([F.col(f"s{k}") for k in range(samples)]).alias("fingerprint"))
    empty = F.lit("0" * (_BITS // 4 * samples))
    out = keyed.select(id_col, "h").alias("d").join(made.alias("m"), F.col(f"d.{id_col}").eqNullSafe(F.col(f"m.{id_col}")) & (F.col("d.h") == F.col("m.h")), "left")
    return out.select(F.col(f"d.{id_col}"), F.coalesce("m.fingerprint", empty).alias("fingerprint"))


def _ordered(df: DataFrame) -> DataFrame:
    """Distinct (key, h) with n_chars, copies and the keys before and after in ascending order, the ends joined."""
    ids = df.groupBy("key", "h").agg(F.max("n_chars").alias("n_chars"), F.max("none").alias("none"), F.count("*").alias("copies"))
    # ids grow with the place in the order; the upper 31 bits are the partition
    ids = cut(ids.repartitionByRange("key", "h").sortWithinPartitions("key", "h").withColumn("place", F.monotonically_increasing_id()))
    part = F.shiftright("place", 33)
    ends = ids.groupBy(part.alias("part")).agg(F.min("place").alias("first"), F.max("place").alias("last"))
    every = Window.partitionBy(F.lit(0)).orderBy("part")  # a row for each partition
    ends = ends.select(F.col("last").alias("place"), F.coalesce(F.lead("first").over(every), F.min("first").over(Window.partitionBy(F.lit(0)))).alias("over"))
    ids = ids.join(F.broadcast(ends), "place", "left").withColumn("after", F.coalesce("over", F.col("place") + 1)).drop("over")
    after = ids.select(F.col("place").alias("after"), F.col("key").alias("next_key"), F.col("h").alias("next_h"))
    before = ids.select(F.col("after").alias("place"), F.col("key").alias("before_key"), F.col("h").alias("before_h"), F.col("n_chars").alias("before_chars"))
    return ids.join(after, "after").join(before, "place").drop("place", "after")


def with_edits(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", samples: int = SAMPLES) -> DataFrame:
    """Fingerprints of all texts and of their edited texts: the last quarter replaced by the beginning of the next document.

    Gives id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited and near_next.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    number = F.col(id_col).cast("long")
    docs = df.select(F.coalesce(number, F.lit(_NULL_ID)).alias("key"), F.xxhash64(text, number.isNull()).alias("h"), text.alias("text"), number.isNull().alias("none"))
    order = cut(_ordered(docs.select("key", "h", "none", F.length("text").alias("n_chars"))))
    placed = docs.drop("none").join(order, ["key", "h"])
    begins = placed.select(F.col("before_key").alias("key"), F.col("before_h").alias("h"), F.expr("substring(text, 1, int(before_chars div 4))").alias("begin"))
    begins = begins.groupBy("key", "h").agg(F.max("begin").alias("begin"))
    # words up to the last white space before the cut are those of both texts; the word at the cut goes with what follows
    cut_at = "int(n_chars - n_chars div 4)"
    both = placed.join(begins, ["key", "h"]).withColumn("head", F.expr(f"substring(text, 1, {cut_at})"))
    both = both.withColumn("last", F.regexp_extract("head", "[^\\x20\\x09-\\x0D]*$", 0))
    own = ["key", "h"]
    # words of both texts, the number of copies of a row taken out; where weights agree a term is sampled once for both.
    # The edited text's digest comes along as a part without words, so that texts are dealt out once
    piece = lambda side, t: F.struct(F.lit(side).alias("side"), t.alias("t"))
    shared = F.expr("substring(head, 1, length(head) - length(last))")
    mine, other = F.concat("last", F.expr(f"substring(text, {cut_at} + 1)")), F.concat("last", "begin")
    pieces = F.array(piece(2, shared), piece(0, mine), piece(1, other), piece(3, F.sha2(F.concat("head", "begin"), 256)))
    sides = both.select(*own, "copies", F.explode(pieces).alias("s"))
    each = sides.select(*own, "copies", F.col("s.side").alias("side"), F.explode(words(F.col("s.t"))).alias("word")).where("word <> ''")
    digest = F.when(F.col("side") == 3, F.col("word")).alias("digest")  # a key, as texts in buffers make aggregation sort
    counts = each.groupBy(*own, "copies", F.xxhash64("word").alias("term"), digest).agg(F.count_if(F.col("side").isin(0, 2)).alias("a"), F.count_if(F.col("side").isin(1, 2)).alias("b"))
    parts = F.when(F.col("digest").isNotNull(), F.array(F.struct(F.lit(3).alias("side"), F.lit(1).cast("long").alias("w")))).when(F.col("a") == F.col("b"), F.array(F.struct(F.lit(2).alias("side"), F.col("a").alias("w")))).otherwise(F.array(F.struct(F.lit(0).alias("side"), F.col("a").alias("w")), F.struct(F.lit(1).alias("side"), F.col("b").alias("w"))))
    terms = counts.select(*own, "term", "digest", F.explode(parts).alias("p"), "copies").where("p.w > 0").select(*own, "term", "digest", F.col("p.side").alias("side"), (F.col("p.w") / F.col("copies")).alias("weight"))
    made = sketches(terms, [*own, "side", "digest"], samples)
    least = made.groupBy(*own).agg(
        F.max("digest").alias("edited_sha256"),
        *[F.min(F.when(F.col("side").isin(0, 2), F.col(f"s{k}"))).alias(f"a{k}") for k in range(samples)],
        *[F.min(F.when(F.col("side").isin(1, 2), F.col(f"s{k}"))).alias(f"b{k}") for k in range(samples)],
    )
    zero = "0" * (_BITS // 4 * samples)
    packed = lambda side: F.unhex(F.coalesce(as_text([F.col(f"{side}{k}") for k in range(samples)]), F.lit(zero)))
    prints = cut(least.select(*own, F.unhex("edited_sha256").alias("edited_sha256"), packed("a").alias("fingerprint"), packed("b").alias("edited_fingerprint")))
    following = prints.select(F.col("key").alias("next_key"), F.col("h").alias("next_h"), F.col("fingerprint").alias("next_fingerprint"))
    out = order.select(*own, "none", "n_chars", "copies", "next_key", "next_h").join(prints, own).join(following, ["next_key", "next_h"], "left")
    none = F.lit(bytes(_BITS // 8 * samples))
    out = out.withColumns({c: F.coalesce(c, none) for c in ("fingerprint", "edited_fingerprint", "next_fingerprint")})
    out = out.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return out.select(
        F.when(~F.col("none"), F.col("key")).alias(id_col),
        F.col("n_chars").cast("long").alias("n_chars"),
        F.lower(F.hex("edited_sha256")).alias("edited_sha256"),
        F.lower(F.hex("fingerprint")).alias("fingerprint"),
        F.lower(F.hex("edited_fingerprint")).alias("edited_fingerprint"),
        likeness(F.col("fingerprint"), F.col("edited_fingerprint"), samples).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_fingerprint"), samples).alias("near_next"),
    )
