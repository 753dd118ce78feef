"""Frame queries: embeddings stand in for frames of 8 x 8 unsigned 16-bit samples with four zero low bits."""

from __future__ import annotations

from pyspark.sql import functions as F

from strataframe.operators import catalog as C
from strataframe.operators import frames as X
from strataframe.operators import ordered as O
from strataframe.plans.catalog_queries import read

QUERIES: dict = {}
ORACLE: dict = {}

SAMPLE_SQL = "cast(floor((e + 1) * 2048) as integer) * 16"
PX_SQL = f"(select vec_id, label, i - 1 px, {SAMPLE_SQL} v from (select vec_id, label, generate_subscripts(embedding, 1) i, cast(unnest(embedding) as double) e from embeddings))"
FRAMES_SQL = f"(select vec_id, label, list_transform(embedding, lambda x: cast(floor((cast(x as double) + 1) * 2048) as integer) * 16) s from embeddings)"


def query(sql: str | None = None):
    def keep(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return keep


def frames(spark, d):
    samples = F.transform("embedding", lambda x: F.floor((x.cast("double") + 1) * 2048).cast("int") * 16)
    return read(spark, d, "embeddings").select("vec_id", "label", samples.alias("samples"))


@query(f"""select f.label, f.vec_id, row_number() over (partition by f.label order by f.vec_id) - 1 acq_idx, m.shift, m.payload_bits, sha256(array_to_string(list_transform(f.s, lambda x: x // (1 << m.shift)), ',')) digest
from {FRAMES_SQL} f join (select label, bit_count((o & -o) - 1)::int shift, length(bin(o)) - bit_count((o & -o) - 1)::int payload_bits from (select label, bit_or(v) o from {PX_SQL} group by 1)) m using (label)""")
def frame_index(spark, d):
    """Frames in acquisition order with the shift of their group and the digest of their shifted samples."""
    f = frames(spark, d)
    ranges = X.shift_range(f, ["label"])  # a row for each archive
    named = f.withColumn("name", F.concat(F.lit("1/frame-"), "vec_id"))
    ordered = C.acquisition_order(named, ["label"], "name", "vec_id").join(ranges, "label")
    shifted = F.array_join(F.transform("samples", lambda x: F.floor(x / F.pow(F.lit(2), F.col("shift"))).cast("int").cast("string")), ",")
    return ordered.select("label", "vec_id", "acq_idx", "shift", F.col("payload_bits"), F.sha2(shifted, 256).alias("digest"))


@query(f"select label, bit_or(v)::int or_mask from {PX_SQL} group by 1")
def a1_bit_or(spark, d):
    return X.shift_range(frames(spark, d), ["label"]).select("label", "or_mask")


@query(f"select vec_id, bit_and(v)::int and_mask from {PX_SQL} group by 1")
def a2_bit_and(spark, d):
    return frames(spark, d).select("vec_id", X.fold(F.col("samples"), "and").alias("and_mask"))


@query(f"select label, bit_count((o & -o) - 1)::int shift, (length(bin(o)) - bit_count((o & -o) - 1))::int payload_bits from (select label, bit_or(v) o from {PX_SQL} group by 1)")
def x4_shift_detection(spark, d):
    return X.shift_range(frames(spark, d), ["label"]).select("label", "shift", "payload_bits")


@query(f"select label, round(log2(sum(n)) - sum(n * log2(n)) / sum(n), 6) bits from (select label, v, count(*) n from {PX_SQL} group by 1, 2) group by 1")
def a20_entropy(spark, d):
    return X.entropy(frames(spark, d), ["label"])


@query(f"select (v // 16) & 15 nibble, count(*)::bigint n from {PX_SQL} group by 1")
def a21_low_nibble(spark, d):
    """Low nibble of the samples without their four zero bits."""
    shifted = frames(spark, d).withColumn("samples", F.transform("samples", lambda x: F.shiftright(x, 4)))
    return X.histogram(shifted, [], of=lambda x: x & 15).select(F.col("v").cast("int").alias("nibble"), "n")


@query(f"select label, min(g)::int smallest, max(g)::int largest, count(*) n from (select label, v - lag(v) over (partition by label order by v) g from (select distinct label, v from {PX_SQL})) where g is not null group by 1")
def a22_value_gaps(spark, d):
    from pyspark.sql import Window

    v = X.histogram(frames(spark, d), ["label"]).select("label", "v")  # at most 65,536 rows for a label
    g = v.select("label", (F.col("v") - F.lag("v").over(Window.partitionBy("label").orderBy("v"))).cast("int").alias("g")).where("g is not null")
    return g.groupBy("label").agg(F.min("g").alias("smallest"), F.max("g").alias("largest"), F.count("*").alias("n"))


@query(f"select label, px, vec_id % 2 parity, round(avg(v), 4) mean, round(stddev_pop(v), 4) sd from {PX_SQL} group by 1, 2, 3")
def a23_pixel_mean_sd(spark, d):
    p = X.pixel_stats(frames(spark, d).withColumn("parity", F.col("vec_id") % 2), ["label", "parity"])
    return p.select("label", F.col("px").cast("long").alias("px"), "parity", F.round("mean", 4).alias("mean"), F.round("sd", 4).alias("sd"))


@query(f"select label, round(avg(log2(sqrt(2 * pi() * exp(1)) * greatest(sd, 0.5))), 6) floor_bits from (select label, px, stddev_pop(v) sd from {PX_SQL} group by 1, 2) group by 1")
def a24_noise_floor(spark, d):
    sd = X.pixel_stats(frames(spark, d), ["label"])
    return sd.groupBy("label").agg(F.round(F.avg(F.log2(F.sqrt(F.lit(2) * F.pi() * F.e()) * F.greatest("sd", F.lit(0.5)))), 6).alias("floor_bits"))


@query(f"select vec_id // 40 block, vec_id % 2 parity, round(avg(v), 6) mean from {PX_SQL} group by 1, 2")
def a25_block_mean(spark, d):
    f = frames(spark, d).select(F.floor(F.col("vec_id") / 40).alias("block"), (F.col("vec_id") % 2).alias("parity"), "samples")
    return X.histogram(f, ["block", "parity"]).groupBy("block", "parity").agg(F.round(F.sum(F.col("v") * F.col("n")) / F.sum("n"), 6).alias("mean"))


@query(f"select vec_id, min(v)::int lowest, max(v)::int highest, round(avg(v), 6) mean from {PX_SQL} group by 1")
def x16_frame_stats(spark, d):
    s = F.col("samples")
    mean = F.aggregate(s, F.lit(0).cast("long"), lambda a, x: a + x) / F.size(s)
    return frames(spark, d).select("vec_id", F.array_min(s).alias("lowest"), F.array_max(s).alias("highest"), F.round(mean, 6).alias("mean"))


@query(f"select label, vec_id, sum(abs(v - p))::bigint residual from (select *, lag(v) over (partition by label, px order by vec_id) p from {PX_SQL}) where p is not null group by 1, 2")
def w6_temporal_delta(spark, d):
    f = O.with_previous(frames(spark, d), ["label"], "vec_id", ["samples"]).where("samples_before is not null")
    delta = F.aggregate(F.zip_with("samples", "samples_before", lambda a, b: F.abs(a - b)), F.lit(0).cast("long"), lambda s, x: s + x)
    return f.select("label", "vec_id", delta.alias("residual"))


@query(f"""select vec_id, round(avg(r), 6) coherence from (select a.vec_id, a.px // 8 r0, (avg(a.v::double * b.v) - avg(a.v::double) * avg(b.v::double)) / (sqrt(greatest(avg(a.v::double * a.v) - avg(a.v::double) * avg(a.v::double), 0) * greatest(avg(b.v::double * b.v) - avg(b.v::double) * avg(b.v::double), 0)) + 1e-12) r
from {PX_SQL} a join {PX_SQL} b on a.vec_id = b.vec_id and b.px = a.px + 8 group by 1, 2) group by 1""")
def x14_row_coherence(spark, d):
    return X.row_coherence(frames(spark, d), ["vec_id"], 8).select("vec_id", F.round("coherence", 6).alias("coherence"))


@query("select n, r::int as rows, (n // r)::int as cols from (select n, unnest(range(1, n + 1)) r from (select distinct p_size * 48 n from part)) where n % r = 0 and r / (n / r) between 0.25 and 4")
def f22_factor_pairs(spark, d):
    """Shapes of frames of so many samples."""
    n = read(spark, d, "part").select((F.col("p_size") * 48).alias("n")).distinct()
    return n.select("n", F.explode(X.factor_pair_column(F.col("n"))).alias("p")).select("n", "p.rows", "p.cols")


@query("select label, vec_id from (select label, vec_id, row_number() over (partition by label order by vec_id) - 1 r, count(*) over (partition by label) n from embeddings) where r in (select i * (n - 1) // 6 from (select unnest(range(0, 7)) i)) or n <= 7")
def t7_even_picks(spark, d):
    """Seven evenly spaced frames of each label, or all where there are fewer."""
    return X.pick_evenly(frames(spark, d).select("label", "vec_id"), ["label"], "vec_id", 7)


@query(f"select coalesce(a.k, b.k) k, coalesce(a.n, 0) n_a, coalesce(b.n, 0) n_b from (select sha256(array_to_string(s, ',')) k, count(*) n from {FRAMES_SQL} where vec_id % 10 <> 3 group by 1) a full join (select sha256(array_to_string(list_reverse(list_reverse(s)), ',')) k, count(*) n from {FRAMES_SQL} where vec_id % 10 <> 4 group by 1) b on a.k = b.k where coalesce(a.n, 0) <> coalesce(b.n, 0)")
def u4_permutation_check(spark, d):
    """Frames of which one side has more copies; both sides lack some."""
    f = frames(spark, d).select("vec_id", F.sha2(F.array_join(F.transform("samples", lambda x: x.cast("string")), ","), 256).alias("k"))
    return C.same_multiset(f.where("vec_id % 10 <> 3"), f.where("vec_id % 10 <> 4"), "k")


@query(f"select vec_id, list_sum(list_transform(s, lambda x: x // 256))::bigint high, list_sum(list_transform(s, lambda x: x % 256))::bigint low from {FRAMES_SQL}")
def x18_byte_planes(spark, d):
    total = lambda a: F.aggregate(a, F.lit(0).cast("long"), lambda s, x: s + x)
    return frames(spark, d).select("vec_id", total(F.transform("samples", lambda x: F.shiftright(x, 8))).alias("high"), total(F.transform("samples", lambda x: x.bitwiseAND(F.lit(255)))).alias("low"))


@query(f"select vec_id % 2 channel, count(*) n from embeddings group by 1")
def x21_channels(spark, d):
    return frames(spark, d).groupBy((F.col("vec_id") % 2).alias("channel")).agg(F.count("*").alias("n"))
