"""Catalog and log queries over the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataframe.functions import scalars as S
from strataframe.operators import catalog as C
from strataframe.operators import frames as X
from strataframe.operators import ordered as O
from strataframe.operators import picks as K

QUERIES: dict = {}
ORACLE: dict = {}


def query(sql: str | None = None):
    def keep(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return keep


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cents():
    return F.round(F.col("o_totalprice") * 100).cast("long")


CENTS_SQL = "cast(round(o_totalprice * 100) as bigint)"


@query(f"select o_orderpriority, count(*) n, sum({CENTS_SQL})::bigint total_bytes from orders group by 1")
def a3_kind_rollup(spark, d):
    return C.rollup(read(spark, d, "orders"), ["o_orderpriority"], cents())


@query(f"select o_orderpriority, o_orderstatus, year(o_orderdate)::int y, count(*) n, sum({CENTS_SQL})::bigint total_bytes from orders group by 1, 2, 3")
def a4_multi_key_rollup(spark, d):
    return C.rollup(read(spark, d, "orders").withColumn("y", F.year("o_orderdate")), ["o_orderpriority", "o_orderstatus", "y"], cents())


@query(f"select o_orderstatus, count(*) n, sum({CENTS_SQL})::bigint total_bytes, round(100.0 * sum({CENTS_SQL})::double / (select sum({CENTS_SQL}) from orders)::double, 4) percent from orders group by 1")
def a5_share_of_total(spark, d):
    return C.share(read(spark, d, "orders"), ["o_orderstatus"], cents())


@query("""select l_suppkey, v modal_value, n modal_count from (select *, row_number() over (partition by l_suppkey order by n desc, seen) r from
(select l_suppkey, l_quantity v, count(*) n, min(l_orderkey * 10 + l_linenumber) seen from lineitem where l_quantity <> 0 group by 1, 2)) where r = 1""")
def a6_modal_value(spark, d):
    items = read(spark, d, "lineitem").select("l_suppkey", "l_quantity", (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("at"))
    return C.modal(items, ["l_suppkey"], "l_quantity", "at")


@query("select l_returnflag, round(sum(cast(round(l_extendedprice * 100) as bigint))::double / greatest(sum(cast(l_quantity as bigint)), 1)::double, 6) ratio from lineitem group by 1")
def a7_pooled_ratio(spark, d):
    return C.pooled_ratio(read(spark, d, "lineitem"), ["l_returnflag"], F.round(F.col("l_extendedprice") * 100).cast("long"), F.col("l_quantity").cast("long"))


@query('select concat(l_returnflag, l_linestatus) l_shipmode_like, count(*) n, count(*) filter (l_discount > 0.05) discounted, count(*) filter (l_tax = 0) untaxed from lineitem group by 1')
def a8_conditional_counts(spark, d):
    rows = read(spark, d, "lineitem").withColumn("l_shipmode_like", F.concat("l_returnflag", "l_linestatus"))
    return C.conditional_counts(rows, ["l_shipmode_like"], discounted=F.col("l_discount") > 0.05, untaxed=F.col("l_tax") == 0)


@query(f"select o_orderpriority, min({CENTS_SQL}) smallest, max({CENTS_SQL}) largest, arg_max(o_orderkey, {CENTS_SQL} * 1000000000 - o_orderkey) largest_key from orders group by 1")
def a9_extremes(spark, d):
    o = read(spark, d, "orders").withColumn("c", cents())
    return o.groupBy("o_orderpriority").agg(F.min("c").alias("smallest"), F.max("c").alias("largest"), F.max_by("o_orderkey", F.struct("c", -F.col("o_orderkey"))).alias("largest_key"))


_RANKED = "select o_orderpriority k, o_totalprice v, row_number() over (partition by o_orderpriority order by o_totalprice) - 1 r, count(*) over (partition by o_orderpriority) n from orders"


@query(f"select k o_orderpriority, " + ", ".join(f"max(case when r = least(n - 1, {q} * n // 100) then v end) q{q}" for q in (0, 25, 50, 75, 95, 100)) + f" from ({_RANKED}) group by 1")
def a10_nearest_rank(spark, d):
    return O.nearest_rank(read(spark, d, "orders"), ["o_orderpriority"], "o_totalprice")


@query(f"select k o_orderpriority, max(case when r = least(n - 1, 50 * n // 100) then v end) upper_median from ({_RANKED}) group by 1")
def a11_upper_median(spark, d):
    return O.nearest_rank(read(spark, d, "orders"), ["o_orderpriority"], "o_totalprice", (50,)).withColumnRenamed("q50", "upper_median")


@query("select strftime(ts, '%Y-%m-%d') as day, count(*) n, round(sum(value), 2) total from events group by 1")
def a12_daily_rollup(spark, d):
    return read(spark, d, "events").groupBy(F.date_format("ts", "yyyy-MM-dd").alias("day")).agg(F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("total"))


@query("""select case when cast(json_extract_string(props, '$.k') as bigint) % 10 = 0 then 'transient' else event_type end event, count(*) n,
sum(case when cast(json_extract_string(props, '$.k') as bigint) % 10 = 0 then 0 else cast(floor(value * 100) as bigint) end)::bigint total_bytes from events group by 1""")
def a13_event_rollup(spark, d):
    e = read(spark, d, "events").withColumn("t", F.get_json_object("props", "$.k").try_cast("long") % 10 == 0)
    size = F.when(F.col("t"), F.lit(0)).otherwise(F.floor(F.col("value") * 100).cast("long"))
    return C.rollup(e.withColumn("event", F.when(F.col("t"), "transient").otherwise(F.col("event_type"))), ["event"], size)


@query('select substring(p_type, 1, 4) reason, count(*) n from part where p_size > 10 group by substring(p_type, 1, 4)')
def a14_reason_histogram(spark, d):
    p = read(spark, d, "part").where("p_size > 10")
    return C.conditional_counts(p.withColumn("reason", F.substring("p_type", 1, 4)), ["reason"])


@query("""select case when a <= 7 then '<=7' when a <= 30 then '<=30' when a <= 90 then '<=90' when a <= 365 then '<=365' else '>365' end bucket, count(*) n from
(select date_diff('day', cast(o_orderdate as date), date '2001-01-01') a from orders) group by 1""")
def a15_age_buckets(spark, d):
    days = F.datediff(F.lit("2001-01-01").cast("date"), F.col("o_orderdate").cast("date"))
    return read(spark, d, "orders").groupBy(S.age_bucket(days).alias("bucket")).agg(F.count("*").alias("n"))


@query("select l_returnflag, count(distinct l_suppkey) suppliers, count(distinct l_quantity) quantities from lineitem group by l_returnflag")
def a16_distinct_counts(spark, d):
    return C.distinct_counts(read(spark, d, "lineitem"), ["l_returnflag"], suppliers="l_suppkey", quantities="l_quantity")



@query("select regexp_extract(url, '^https?://([^/]+)', 1) host, sum(octet_length(encode(html)))::bigint total_bytes, count(*) n, max(page_id) newest, min(page_id) oldest from pages group by 1")
def a17_directory_rollup(spark, d):
    p = read(spark, d, "pages").withColumn("host", F.regexp_extract("url", "^https?://([^/]+)", 1))
    return p.groupBy("host").agg(F.sum(F.octet_length("html")).cast("long").alias("total_bytes"), F.count("*").alias("n"), F.max("page_id").alias("newest"), F.min("page_id").alias("oldest"))


@query("select count(*) n, sum(p_size)::bigint total_bytes from part where p_brand in ('Brand#1', 'Brand#2')")
def a18_total_of_kinds(spark, d):
    return C.rollup(C.in_scope(read(spark, d, "part"), kinds=("p_brand", ["Brand#1", "Brand#2"])), [], F.col("p_size"))


@query("select c.c_custkey, count(o.o_orderkey) > 0 and coalesce(min(case when o.o_orderstatus = 'F' then 1 else 0 end), 0) = 1 all_verified from customer c left join orders o on c.c_custkey = o.o_custkey group by c.c_custkey")
def a19_all_verified(spark, d):
    return C.all_of(read(spark, d, "customer").select("c_custkey"), read(spark, d, "orders").withColumnRenamed("o_custkey", "c_custkey"), "c_custkey", F.col("o_orderstatus") == "F", "all_verified")


@query('select round(sum(o_totalprice) / 1e6 / 86.7 / 86400, 9) days_needed, round(sum(o_totalprice) / 1e6 * 6.0, 2) cost from orders')
def a26_cost_projection(spark, d):
    total = read(spark, d, "orders").agg(F.sum("o_totalprice").alias("t"))
    return total.select(F.round(S.days_needed(F.col("t"), 86.7), 9).alias("days_needed"), F.round(S.cost(F.col("t"), 6.0), 2).alias("cost"))


@query('select count(*) n, count(l.doc_id) present, round(100.0 * count(l.doc_id) / count(*), 4) percent from documents d left join labels l on d.doc_id = l.doc_id')
def a27_storage_status(spark, d):
    return C.presence(read(spark, d, "documents").select("doc_id"), read(spark, d, "labels"), "doc_id")


@query("""select case when url ~ '/[a-z]{2}/[0-9]+' then 'numbered' when url like 'https%' then 'secure' when url like '%ref=%' then 'referred' else 'other' end kind, count(*) n from pages group by 1""")
def p1_classify(spark, d):
    u = F.col("url")
    kind = C.first_match([(u.rlike("/[a-z]{2}/[0-9]+"), "numbered"), (u.startswith("https"), "secure"), (u.contains("ref="), "referred")], "other")
    return read(spark, d, "pages").groupBy(kind.alias("kind")).agg(F.count("*").alias("n"))


@query("select p_partkey, p_size from part where p_type in ('ECONOMY', 'STANDARD') and p_size > 0")
def p2_in_scope(spark, d):
    return C.in_scope(read(spark, d, "part"), kinds=("p_type", ["ECONOMY", "STANDARD"]), size="p_size").select("p_partkey", "p_size")


@query("select o_orderkey, o_totalprice from orders where o_orderstatus = 'F' and o_totalprice between 1000 and 200000 and o_orderpriority in ('1-URGENT', '2-HIGH')")
def p3_work_list(spark, d):
    rows = read(spark, d, "orders").where("o_orderstatus = 'F'")
    return C.in_scope(rows, kinds=("o_orderpriority", ["1-URGENT", "2-HIGH"]), size="o_totalprice", least=1000, most=200_000).select("o_orderkey", "o_totalprice")


_NAMED = "(select p_partkey, case p_partkey % 4 when 0 then p_name || '.ap.bin' when 1 then p_name || '.lf.bin' when 2 then p_name || '.nidq.bin' else p_name end n from part)"


@query(f"select p_partkey, regexp_extract(n, '[.](ap|lf|nidq)[.]bin$', 1) band from {_NAMED}")
def p4_band(spark, d):
    k = F.col("p_partkey") % 4
    name = F.concat("p_name", F.when(k == 0, ".ap.bin").when(k == 1, ".lf.bin").when(k == 2, ".nidq.bin").otherwise(""))
    return read(spark, d, "part").select("p_partkey", S.band(name).alias("band"))


_PLACED = "(select o_orderkey, case when o_orderkey % 9 = 0 then 'Z:/other/x' else 'Y:/Subjects/C' || o_custkey || '/' || case when o_orderkey % 7 = 0 then 'notes' else strftime(o_orderdate, '%Y-%m-%d') end || '/' || o_orderkey % 4 || '/a.tar' end p from orders)"


@query(f"""select o_orderkey, case when p like 'Y:%' then split_part(p, '/', 3) else '' end subject, case when regexp_matches(split_part(p, '/', 4), '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}$') and p like 'Y:%' then split_part(p, '/', 4) else '' end date,
case when regexp_matches(split_part(p, '/', 4), '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}$') and p like 'Y:%' then split_part(p, '/', 5) else '' end session from {_PLACED}""")
def p5_session_parts(spark, d):
    return placed(spark, d).select("o_orderkey", S.session_parts(F.col("p"), "Y:/Subjects").alias("s")).select("o_orderkey", "s.*")


def placed(spark, d):
    """Orders as files of sessions; some outside the root, some in folders that aren't dates."""
    k = F.col("o_orderkey")
    day = F.when(k % 7 == 0, "notes").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    path = F.when(k % 9 == 0, "Z:/other/x").otherwise(F.concat(F.lit("Y:/Subjects/C"), "o_custkey", F.lit("/"), day, F.lit("/"), k % 4, F.lit("/a.tar")))
    return read(spark, d, "orders").select("o_orderkey", path.alias("p"))


_RECORDINGS = "(select p_partkey, case when p_partkey % 11 = 0 then null when p_partkey % 17 = 0 then 0 else p_size * 770 + p_partkey % 3 * 385 end size, p_partkey % 5 = 0 coded, case when p_partkey % 7 = 0 then null else true end meta, case when p_partkey % 13 = 0 then 0 else 385 end channels, 30000.0 rate from part)"


@query(f"""select p_partkey, case when size is null then 'size unknown' when coded then 'compressed already' when meta is null then 'no description' when channels = 0 then 'no channels or rate'
when size % (2 * channels) <> 0 then 'no whole number of samples' when size = 0 then 'empty' end reason from {_RECORDINGS}""")
def p6_skip_ladder(spark, d):
    k = F.col("p_partkey")
    size = F.when(k % 11 == 0, F.lit(None)).when(k % 17 == 0, F.lit(0)).otherwise(F.col("p_size") * 770 + k % 3 * 385)
    reason = S.skip_reason(size.cast("long"), k % 5 == 0, F.when(k % 7 != 0, F.lit(True)), F.when(k % 13 == 0, 0).otherwise(385), F.lit(30000.0))
    return read(spark, d, "part").select("p_partkey", reason.alias("reason"))

@query('select d.doc_id, d.doc_id in (select doc_id from labels) has_label from documents d')
def p7_companions(spark, d):
    return C.with_companion(read(spark, d, "documents").select("doc_id"), read(spark, d, "labels"), "doc_id", "has_label")


@query("select event_id from events where ts <= timestamp '2024-01-10 00:00:00'")
def p8_min_age(spark, d):
    now = F.to_timestamp(F.lit("2024-01-10 01:00:00"))
    return read(spark, d, "events").where(S.old_enough(F.col("ts"), now, 3600)).select("event_id")


@query("select page_id from pages where url like '%ref=%' and url not like '%.partial-%'")
def p10_transient(spark, d):
    return read(spark, d, "pages").where(S.transient(F.col("url"), "ref=") & ~S.transient(F.col("url"))).select("page_id")


@query("select p_partkey, p_partkey % 3 = 0 and (p_size % 7 = 0 or p_partkey % 10 = 0) blocked from part")
def p13_blocked_geometry(spark, d):
    """Every third part stands for headerless frames; some have no rows, some no columns."""
    k = F.col("p_partkey")
    kind, cols = S.member_kind(F.concat(F.when(k % 3 == 0, "1/frame-").otherwise("1/x.tif"), k.cast("string"), F.when(k % 3 == 0, "").otherwise(".tif"))), F.when(k % 10 != 0, F.lit(560))
    return read(spark, d, "part").select("p_partkey", S.blocked_geometry(kind, F.col("p_size") % 7, cols).alias("blocked"))

_LATEST = "select user_id, event_id, event_type, value from (select *, row_number() over (partition by user_id order by event_id desc) r from events where event_type <> 'error') where r = 1"


@query(_LATEST)
def w2_latest_success(spark, d):
    return C.latest(read(spark, d, "events").where("event_type <> 'error'").select("user_id", "event_id", "event_type", "value"), ["user_id"], ["event_id"])


@query(f"select user_id, event_id from ({_LATEST}) where value > 20")
def w3_latest_valid(spark, d):
    return w2_latest_success(spark, d).where("value > 20").select("user_id", "event_id")


@query("select user_id, max(event_id) event_id from events where event_type = 'purchase' and value > 5 and ts >= timestamp '2024-01-20 00:00:00' group by user_id")
def w4_recent_check(spark, d):
    e = read(spark, d, "events").where("event_type = 'purchase' and value > 5 and ts >= timestamp '2024-01-20 00:00:00'")
    return C.latest(e.select("user_id", "event_id"), ["user_id"], ["event_id"])


@query("select p_brand, p_type, p_partkey, p_size from (select *, row_number() over (partition by p_brand, p_type order by p_size, p_partkey) r from part) where r = 1")
def w5_smallest_per_group(spark, d):
    p = read(spark, d, "part").select("p_brand", "p_type", "p_partkey", "p_size")
    return p.groupBy("p_brand", "p_type").agg(F.min(F.struct("p_size", "p_partkey")).alias("m")).select("p_brand", "p_type", "m.p_partkey", "m.p_size")


@query("""select source, min(doc_id) as first, max(doc_id) as last, count(*) members from (select *, (row_number() over (partition by source, run order by doc_id) - 1) // 4 cell from
(select source, doc_id, sum(gap) over (partition by source order by doc_id) run from (select source, doc_id, case when doc_id - lag(doc_id) over (partition by source order by doc_id) <> 1 then 1 else 0 end gap from documents)))
group by source, run, cell""")
def w7_spans(spark, d):
    return O.spans(read(spark, d, "documents"), ["source"], "doc_id", 4)


@query('select doc_id, doc_id - 100 slot from documents where doc_id >= 100 and doc_id < 400')
def w8_slots(spark, d):
    return C.slots(read(spark, d, "documents").select("doc_id"), "doc_id", 100, 400)


@query('select min(p_partkey) first_break from part where p_size > 45')
def w10_first_break(spark, d):
    return C.first_break(read(spark, d, "part"), [], "p_partkey", F.col("p_size") > 45)


@query("select source, doc_id, (16 + coalesce(sum(n_chars) over (partition by source order by doc_id rows between unbounded preceding and 1 preceding), 0))::bigint as offset from documents")
def w11_running_offset(spark, d):
    return C.running_offset(read(spark, d, "documents").select("source", "doc_id", "n_chars"), ["source"], "doc_id", "n_chars", 16).select("source", "doc_id", "offset")


_W1 = "select doc_id, source, n from (select doc_id, source, try_cast(regexp_extract(concat('1/frame-', (doc_id * 7919) % 100003, '.tif'), '([0-9]+)(\\.[A-Za-z0-9]+)?$', 1) as bigint) n from documents)"


@query(f"select source, doc_id, case when count(*) over w0 = count(n) over w0 and max(dn) over w0 = count(n) over w0 then row_number() over (partition by source order by n, doc_id) - 1 end acq_idx from (select a.*, b.dn from ({_W1}) a join (select source, count(distinct n) dn from ({_W1}) group by 1) b using (source)) window w0 as (partition by source)")
def w1_acquisition_order(spark, d):
    named = read(spark, d, "documents").select("source", "doc_id", F.concat(F.lit("1/frame-"), (F.col("doc_id") * 7919) % 100003, F.lit(".tif")).alias("name"))
    return C.acquisition_order(named, ["source"], "name", "doc_id").drop("name")


@query("select o_orderkey, o_totalprice, row_number() over (partition by o_orderpriority order by o_totalprice desc, o_orderkey) place from orders")
def t1_sorted_work(spark, d):
    o = read(spark, d, "orders").select("o_orderpriority", "o_orderkey", "o_totalprice", (-F.col("o_totalprice")).alias("less"))
    return O.ranked(o, ["o_orderpriority"], "less", "place", ["o_orderkey"]).select("o_orderkey", "o_totalprice", (F.col("place") + 1).alias("place"))


@query("select o_orderkey from orders where o_orderstatus = 'F' order by o_totalprice, o_orderkey limit 50")
def t2_limit_after_filter(spark, d):
    return K.top(read(spark, d, "orders").where("o_orderstatus = 'F'"), ["o_totalprice", "o_orderkey"], 50).select("o_orderkey")


@query("select o_orderkey from (select o_orderkey, sum(cast(round(o_totalprice * 100) as bigint)) over (order by o_orderkey) - cast(round(o_totalprice * 100) as bigint) b from orders) where b < 5000000000")
def t3_cumulative_stop(spark, d):
    return K.cumulative_stop(read(spark, d, "orders").select("o_orderkey", cents().alias("c")), "o_orderkey", "c", 5_000_000_000).select("o_orderkey")

@query('select c_custkey, c_acctbal from customer order by c_acctbal desc, c_custkey limit 20')
def t4_top_n(spark, d):
    return K.top(read(spark, d, "customer").select("c_custkey", "c_acctbal"), ["-c_acctbal", "c_custkey"], 20)


@query("select c_custkey, c_name, c_acctbal from customer order by c_acctbal, c_custkey limit 1")
def t5_min_by(spark, d):
    return K.smallest(read(spark, d, "customer").select("c_custkey", "c_name", "c_acctbal"), "c_acctbal", ["c_custkey"])

@query('select doc_id from documents where doc_id % 20 = 0 order by doc_id limit 40')
def t10_stride_sample(spark, d):
    return K.stride_sample(read(spark, d, "documents").select("doc_id"), "doc_id", 20, 40)


@query("select text, min(doc_id) doc_id from documents group by text")
def u1_dedup_first(spark, d):
    return C.first_seen(read(spark, d, "documents").select("text", "doc_id"), ["text"], "doc_id")


@query("select event_id, value, null::varchar role from events where event_type = 'error' union all select conv_id, null, role from conversations")
def u2_union_logs(spark, d):
    a = read(spark, d, "events").where("event_type = 'error'").select("event_id", "value")
    return a.unionByName(read(spark, d, "conversations").select(F.col("conv_id").alias("event_id"), "role"), allowMissingColumns=True)


@query("select distinct p_brand, p_type from part except select distinct p_brand, p_type from part where p_size > 25 and p_partkey % 4 = 0")
def u3_missing_strata(spark, d):
    p = read(spark, d, "part").select("p_brand", "p_type", "p_size", "p_partkey")
    return K.missing_strata(p, p.where("p_size > 25 and p_partkey % 4 = 0"), ["p_brand", "p_type"])

@query('select coalesce(a.doc_id, b.doc_id) doc_id, a.doc_id is null only_b, b.doc_id is null only_a from (select doc_id from documents where doc_id % 3 <> 0) a full join (select doc_id from documents where doc_id % 4 <> 0) b on a.doc_id = b.doc_id where a.doc_id is null or b.doc_id is null')
def u5_member_difference(spark, d):
    ids = read(spark, d, "documents").select("doc_id")
    return C.member_difference(ids.where("doc_id % 3 <> 0"), ids.where("doc_id % 4 <> 0"), "doc_id")


@query("select lang, array_to_string(list_slice(list_sort(list_distinct(list(source))), 1, 6), ' | ') sources from documents group by 1")
def u6_joined_names(spark, d):
    return read(spark, d, "documents").groupBy("lang").agg(F.array_join(F.slice(F.array_sort(F.collect_set("source")), 1, 6), " | ").alias("sources"))


@query("select d.doc_id from documents d where not exists (select 1 from labels l where l.doc_id = d.doc_id)")
def j1_remaining_work(spark, d):
    return C.remaining(read(spark, d, "documents").select("doc_id"), read(spark, d, "labels"), ["doc_id"])


@query('select o.o_orderkey from orders o where not exists (select 1 from lineitem l where l.l_orderkey = o.o_orderkey and l.l_quantity > 45)')
def j2_todo_not_done(spark, d):
    done = read(spark, d, "lineitem").where("l_quantity > 45").withColumnRenamed("l_orderkey", "o_orderkey")
    return C.remaining(read(spark, d, "orders").select("o_orderkey"), done, ["o_orderkey"])


@query('select distinct lower(p.p_name) name from part p where not exists (select 1 from part q where lower(q.p_name) = lower(p.p_name) and q.p_size = 50)')
def j3_unlogged_outputs(spark, d):
    p = read(spark, d, "part").select(S.canonical_path(F.col("p_name")).alias("name"), "p_size")
    return C.remaining(p.select("name").distinct(), p.where("p_size = 50"), ["name"])


@query("""select d.doc_id, case when l.doc_id is null then 'no receipt' when l.quality <> 1 then 'not verified' when l.toxic = 1 then 'flagged' when d.n_chars < 200 then 'too small' else 'accepted' end verdict
from documents d left join labels l on d.doc_id = l.doc_id""")
def j4_receipt_check(spark, d):
    joined = read(spark, d, "documents").select("doc_id", "n_chars").join(read(spark, d, "labels").withColumn("seen", F.lit(True)), "doc_id", "left")
    verdict = C.first_match([(F.col("seen").isNull(), "no receipt"), (F.col("quality") != 1, "not verified"), (F.col("toxic") == 1, "flagged"), (F.col("n_chars") < 200, "too small")], "accepted")
    return joined.select("doc_id", verdict.alias("verdict"))


_J6 = """select coalesce(o.user_id, n.user_id) user_id, case when n.user_id is null then 'disappeared' when o.user_id is null then 'brand_new' when n.p and not o.p then 'newly_present' when not n.p then 'still_out' else 'unchanged' end state
from (select user_id, bool_or(event_type = 'purchase') p from events where event_id % 3 = 0 group by 1) o full join (select user_id, bool_or(event_type = 'purchase') p from events where event_id % 3 <> 0 and event_id % 5 < 2 group by 1) n on o.user_id = n.user_id"""


@query(_J6)
def j6_snapshot_diff(spark, d):
    e = read(spark, d, "events")
    snap = lambda x: x.groupBy("user_id").agg(F.bool_or(F.col("event_type") == "purchase").alias("present"))
    return C.snapshot_diff(snap(e.where("event_id % 3 = 0")), snap(e.where("event_id % 3 <> 0 and event_id % 5 < 2")), "user_id", "present")


@query("""select page_id, n_nationkey from (select p.page_id, n.n_nationkey, row_number() over (partition by page_id order by pos) r from (select page_id, unnest(string_split(url, '/')) seg, generate_subscripts(string_split(url, '/'), 1) pos from pages) p
join nation n on lower(p.seg) = lower(concat('', n.n_nationkey * 33))) where r = 1""")
def j8_first_segment(spark, d):
    segments = read(spark, d, "pages").select("page_id", F.posexplode(F.split("url", "/")).alias("pos", "seg"))
    top = F.broadcast(read(spark, d, "nation").select("n_nationkey", F.lower(F.concat(F.lit(""), F.col("n_nationkey") * 33)).alias("key")))
    return segments.join(top, F.lower("seg") == F.col("key")).groupBy("page_id").agg(F.min_by("n_nationkey", "pos").alias("n_nationkey"))


@query("select s_suppkey, concat('bucket/', lower(s_name)) object_key, n_name from supplier s join nation n on s.s_nationkey = n.n_nationkey")
def j10_key_rewrite(spark, d):
    s = read(spark, d, "supplier").withColumn("path", F.concat(F.lit("Z:/Bucket/"), F.lower("s_name")))
    n = read(spark, d, "nation").withColumnRenamed("n_nationkey", "s_nationkey")
    return s.join(n, "s_nationkey").select("s_suppkey", S.object_key(F.col("path"), "bucket").alias("object_key"), "n_name")


@query("select p.page_id, count(q.page_id) siblings from pages p left join pages q on split_part(p.url, '/', 4) = split_part(q.url, '/', 4) and split_part(p.url, '/', 3) = split_part(q.url, '/', 3) and p.page_id <> q.page_id group by p.page_id")
def j11_sibling(spark, d):
    part = lambda k: F.split_part("url", F.lit("/"), F.lit(k))
    p = read(spark, d, "pages").select("page_id", part(3).alias("host"), part(4).alias("folder"))
    return C.siblings(p, ["host", "folder"], "page_id", "siblings")


@query("select ((select sum(p_size) from part) - (select sum(p_size) from part where p_type = 'PROMO'))::bigint kept_bytes")
def j16_corrected_totals(spark, d):
    return C.corrected_total(read(spark, d, "part"), "p_size", F.col("p_type") == "PROMO", "kept_bytes")


@query('select p_brand, count(distinct p_size) sizes, count(distinct p_size) <= 1 uniform from part group by p_brand')
def g7_preflight(spark, d):
    return C.distinct_sizes(read(spark, d, "part"), ["p_brand"], "p_size").select("p_brand", "sizes", "uniform")


@query("select o.o_orderkey from orders o left join (select distinct l_orderkey from lineitem where l_shipdate < timestamp '1998-01-01 00:00:00') l on l.l_orderkey = o.o_orderkey where l.l_orderkey is null")
def r1_resume(spark, d):
    done = read(spark, d, "lineitem").where("l_shipdate < timestamp '1998-01-01 00:00:00'").withColumnRenamed("l_orderkey", "o_orderkey")
    return C.remaining(read(spark, d, "orders").select("o_orderkey"), done, ["o_orderkey"])


@query("select doc_id, ((n_chars + 511) // 512 * 512)::bigint padded, ((512 - n_chars % 512) % 512)::bigint padding from documents")
def f2_padding(spark, d):
    return read(spark, d, "documents").select("doc_id", S.padded(F.col("n_chars")).alias("padded"), S.padding(F.col("n_chars")).alias("padding"))


@query('select p_partkey, length(bin(p_size)) bits from part where p_size > 0')
def f6_bits(spark, d):
    return read(spark, d, "part").where("p_size > 0").select("p_partkey", X.bit_length(F.col("p_size")).alias("bits"))


@query("select s_suppkey, round(s_acctbal * 1000 / (385 * 30000.0 * 2), 9) secs from supplier where s_acctbal > 0")
def f9_duration(spark, d):
    return read(spark, d, "supplier").where("s_acctbal > 0").select("s_suppkey", F.round(S.duration_seconds(F.col("s_acctbal") * 1000, F.lit(385), F.lit(30000.0)), 9).alias("secs"))


@query("select c_custkey, try_cast(regexp_extract(c_name, '([0-9]+)$', 1) as bigint) number from customer")
def f10_trailing_number(spark, d):
    return read(spark, d, "customer").select("c_custkey", F.expr("try_cast(regexp_extract(c_name, '([0-9]+)$', 1) as bigint)").alias("number"))


@query("select page_id, lower(concat('y:/data/', replace(url, '/', '/'))) path from pages")
def f11_canonical_path(spark, d):
    """Addresses written with backslashes and in upper case."""
    written = F.concat(F.lit("Y:\\Data\\"), F.upper(F.replace(F.col("url"), F.lit("/"), F.lit("\\"))))
    return read(spark, d, "pages").select("page_id", S.canonical_path(written).alias("path"))


@query("select item, case when trim(s) = '' or s like '/%' or regexp_matches(s, '^[A-Za-z]:') or list_contains(string_split(s, '/'), '..') then false else true end safe from (select page_id item, case page_id % 5 when 0 then '../' || page_id when 1 then '/abs/' || page_id when 2 then 'C:/x' when 3 then '' else 'a/b' || page_id end s from pages)")
def f12_safe_names(spark, d):
    i = F.col("page_id")
    name = F.when(i % 5 == 0, F.concat(F.lit("../"), i)).when(i % 5 == 1, F.concat(F.lit("/abs/"), i)).when(i % 5 == 2, F.lit("C:/x")).when(i % 5 == 3, F.lit("")).otherwise(F.concat(F.lit("a/b"), i))
    return read(spark, d, "pages").select(i.alias("item"), S.safe_name(name).alias("safe"))


@query("select o_orderkey, o_orderkey * 1234 n from orders")
def f14_grouped_integer(spark, d):
    """Numbers written with separators and read back."""
    text = F.format_number(F.col("o_orderkey") * 1234, 0)
    return read(spark, d, "orders").select("o_orderkey", S.grouped_integer(text).alias("n"))


@query("select doc_id, sha256(text) digest from documents")
def f20_digests(spark, d):
    return read(spark, d, "documents").select("doc_id", F.sha2("text", 256).alias("digest"))


@query("select event_id, cast(json_extract_string(props, '$.k') as bigint) k from events")
def f18_json_field(spark, d):
    return read(spark, d, "events").select("event_id", F.get_json_object("props", "$.k").cast("long").alias("k"))
