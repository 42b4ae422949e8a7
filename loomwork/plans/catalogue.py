"""The operator shapes of the document pipeline as queries over the driver's tables, each with SQL that gives equal rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loomwork.functions import scalars as S
from loomwork.operators import relational as R
from loomwork.plans.rules import Rule, extract_all, first_match, first_name, rewrite

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str) -> Callable[[Callable[[SparkSession, str], DataFrame]], Callable[[SparkSession, str], DataFrame]]:
    def add(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[f.__name__] = f
        ORACLE[f.__name__] = sql
        return f

    return add


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


IPV4 = r"([0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3})"
CASCADE = (Rule("card", r"([0-9]{16})", exact=True), Rule("address", IPV4, exact=True), Rule("mail", r"([a-z0-9._]+@[a-z0-9.-]+)", exact=True))


@query(
    f"""select doc_id, coalesce(nullif(regexp_extract(text, '([0-9]{{16}})', 1), ''), nullif(regexp_extract(text, '{IPV4}', 1), ''), nullif(regexp_extract(text, '([a-z0-9._]+@[a-z0-9.-]+)', 1), '')) as hit,
    case when regexp_extract(text, '([0-9]{{16}})', 1) <> '' then 'card' when regexp_extract(text, '{IPV4}', 1) <> '' then 'address' when regexp_extract(text, '([a-z0-9._]+@[a-z0-9.-]+)', 1) <> '' then 'mail' end as rule from documents"""
)
def q01_first_match_cascade(spark, sf_dir):
    text = F.col("text")
    return read(spark, sf_dir, "documents").select("doc_id", first_match(text, CASCADE).alias("hit"), first_name(text, CASCADE).alias("rule"))


@query(f"select doc_id, cast(len(list_distinct(regexp_extract_all(text, '{IPV4}', 1))) as bigint) as n_distinct, cast(len(regexp_extract_all(text, '{IPV4}', 1)) as bigint) as n_all from documents")
def q02_all_matches_distinct(spark, sf_dir):
    found = extract_all(F.col("text"), IPV4)
    return read(spark, sf_dir, "documents").select("doc_id", F.size(F.array_distinct(found)).cast("long").alias("n_distinct"), F.size(found).cast("long").alias("n_all"))


@query("select doc_id, (contains(lower(text), 'license') or ((contains(lower(text), 'the ') or contains(lower(text), 'and ')) and contains(lower(text), 'of '))) as flagged from documents")
def q03_keyword_heuristic(spark, sf_dir):
    low = F.lower("text")
    return read(spark, sf_dir, "documents").select("doc_id", (low.contains("license") | ((low.contains("the ") | low.contains("and ")) & low.contains("of "))).alias("flagged"))


@query(
    """select doc_id, nullif(concat_ws(',', case when quality is null then 'quality' end, case when toxic is null then 'toxic' end, case when trim(coalesce(lang, '')) = '' then 'lang' end), '') as missing
    from documents left join labels using (doc_id)"""
)
def q04_missing_fields(spark, sf_dir):
    rows = read(spark, sf_dir, "documents").join(read(spark, sf_dir, "labels"), "doc_id", "left")
    fields = {n: F.col(n).cast("string") for n in ("quality", "toxic", "lang")}
    return rows.select("doc_id", F.array_join(R.complete_name_list(fields), ",").alias("missing"))


@query("select upper(sha256(text)) as sha256, min(doc_id) as doc_id, count(*) as n_copies from documents group by 1")
def q05_content_hash_dedup(spark, sf_dir):
    return read(spark, sf_dir, "documents").groupBy(F.upper(F.sha2("text", 256)).alias("sha256")).agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("n_copies"))


@query("select user_id, event_type, event_id, value from (select *, row_number() over (partition by user_id, event_type order by ts desc, event_id desc) as r from events) where r = 1")
def q06_last_write_wins(spark, sf_dir):
    return R.last_wins(read(spark, sf_dir, "events"), ["user_id", "event_type"], ["ts", "event_id"]).select("user_id", "event_type", "event_id", "value")


@query("select doc_id, lang from documents where not exists (select 1 from labels where labels.doc_id = documents.doc_id)")
def q07_incremental_anti_join(spark, sf_dir):
    return R.not_done(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"), ["doc_id"]).select("doc_id", "lang")


@query(
    """with a as (select year(o_orderdate) as y, month(o_orderdate) as m, count(*) as n_in from orders group by 1, 2),
    b as (select year(o_orderdate) as y, month(o_orderdate) as m, count(*) as n_out from orders where o_orderstatus <> 'P' group by 1, 2)
    select cast(y as int) as y, cast(m as int) as m, n_in, coalesce(n_out, 0) as n_out, coalesce(n_out, 0) > 0 and n_in = coalesce(n_out, 0) as complete from a left join b using (y, m)"""
)
def q08_partition_completeness(spark, sf_dir):
    orders = read(spark, sf_dir, "orders").select(F.year("o_orderdate").alias("y"), F.month("o_orderdate").alias("m"), "o_orderstatus")
    return R.complete_parts(orders, orders.filter("o_orderstatus <> 'P'"), ["y", "m"]).select("y", "m", "n_in", "n_out", "complete")


_POINTS = "select vec_id, label, cast(embedding[1] as double) * 20 + 55 as lat, cast(embedding[2] as double) * 20 + 37 as lon from embeddings"
_KM = """2 * 6371.0 * atan2(sqrt(pow(sin(({b}.lat - {a}.lat) * pi() / 180 / 2), 2) + cos({a}.lat * pi() / 180) * cos({b}.lat * pi() / 180) * pow(sin(({b}.lon - {a}.lon) * pi() / 180 / 2), 2)),
    sqrt(1 - (pow(sin(({b}.lat - {a}.lat) * pi() / 180 / 2), 2) + cos({a}.lat * pi() / 180) * cos({b}.lat * pi() / 180) * pow(sin(({b}.lon - {a}.lon) * pi() / 180 / 2), 2))))"""
_AB = _KM.format(a="a", b="b")


def _points(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = F.col("embedding")
    return read(spark, sf_dir, "embeddings").select("vec_id", "label", (e[0].cast("double") * 20 + 55).alias("lat"), (e[1].cast("double") * 20 + 37).alias("lon"))


@query(
    f"""with p as ({_POINTS}), m as (select a.vec_id, {_AB} as km, b.vec_id as other from p a join p b on a.label = b.label and a.vec_id <> b.vec_id)
    select vec_id, min_by(other, km) as other, round(min(km), 6) as km from m where km <= 150 group by vec_id"""
)
def q09_nearest_with_limit(spark, sf_dir):
    """The nearest other vector of the same label within 150 km: met in cells of space, so a frequent label is no one key."""
    p = _points(spark, sf_dir)
    found = R.nearest_within(p, p.select("label", F.col("vec_id").alias("other"), "lat", "lon"), "vec_id", "other", ["label"], 150)
    return found.select("vec_id", "other", F.round("km", 6).alias("km"))


@query(
    f"""with p as ({_POINTS}), m as (select a.vec_id, {_AB} as km, b.vec_id as other from p a join p b
    on abs(trunc(a.lat * 20) - trunc(b.lat * 20)) <= 1 and abs(trunc(a.lon * 20) - trunc(b.lon * 20)) <= 1)
    select vec_id, min_by(other, km) as other, round(min(km), 6) as km from m where other <> vec_id group by vec_id"""
)
def q10_grid_nearest(spark, sf_dir):
    p = _points(spark, sf_dir)
    near = p.select("vec_id", "lat", "lon", F.explode(R.around(F.col("lat"), F.col("lon"))).alias("c")).select("vec_id", "lat", "lon", "c.*")
    there = p.select(F.col("vec_id").alias("other"), F.col("lat").alias("lat2"), F.col("lon").alias("lon2"), S.cell(F.col("lat")).alias("cx"), S.cell(F.col("lon")).alias("cy"))
    met = near.join(there, ["cx", "cy"]).filter("other <> vec_id").withColumn("km", S.haversine_km(F.col("lat"), F.col("lon"), F.col("lat2"), F.col("lon2")))
    return met.groupBy("vec_id").agg(F.min_by("other", "km").alias("other"), F.round(F.min("km"), 6).alias("km"))


@query(
    f"""with p as ({_POINTS}), c as (select label, avg(lat) as lat, avg(lon) as lon from p group by label), d as (select a.vec_id, {_AB} as km from p a join c b using (label))
    select case when km <= 25 then 'agrees' when km <= 300 then 'conflict' else 'unrelated' end as verdict, count(*) as n from d group by 1"""
)
def q11_conflict_buckets(spark, sf_dir):
    p = _points(spark, sf_dir)
    c = p.groupBy("label").agg(F.avg("lat").alias("lat2"), F.avg("lon").alias("lon2"))
    km = S.haversine_km(F.col("lat"), F.col("lon"), F.col("lat2"), F.col("lon2"))
    verdict = F.when(km <= 25, "agrees").when(km <= 300, "conflict").otherwise("unrelated")
    return p.join(c, "label").groupBy(verdict.alias("verdict")).agg(F.count("*").alias("n"))


@query("select l_orderkey, l_linenumber, round_even(l_extendedprice * (1 - l_discount) * 100, 0) / 100 as net from lineitem")
def q12_half_even(spark, sf_dir):
    return read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", S.half_even(F.col("l_extendedprice") * (1 - F.col("l_discount")), 2).alias("net"))


@query(
    """select s_suppkey, 3000000 + s_nationkey::bigint as a1, 5000000 + n_regionkey::bigint as a2, r_name from supplier join nation on s_nationkey = n_nationkey join region on n_regionkey = r_regionkey"""
)
def q13_ancestors(spark, sf_dir):
    """Suppliers, nations and regions as one forest, walked upwards."""
    s = read(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), (3_000_000 + F.col("s_nationkey").cast("long")).alias("up"))
    n = read(spark, sf_dir, "nation").select((3_000_000 + F.col("n_nationkey").cast("long")).alias("id"), (5_000_000 + F.col("n_regionkey").cast("long")).alias("up"))
    r = read(spark, sf_dir, "region")
    tree = s.unionByName(n).unionByName(r.select((5_000_000 + F.col("r_regionkey").cast("long")).alias("id"), F.lit(None).cast("long").alias("up")))
    walked = R.ancestors(tree, "id", "up", depth=3).filter("id < 3000000")
    named = r.select((5_000_000 + F.col("r_regionkey").cast("long")).alias("a2"), "r_name")
    return walked.select(F.col("id").alias("s_suppkey"), F.col("ancestors")[0].alias("a1"), F.col("ancestors")[1].alias("a2")).join(named, "a2").select("s_suppkey", "a1", "a2", "r_name")


_DELTA = "select c_custkey, c_name || '*' as c_name, c_nationkey, c_acctbal, c_mktsegment, c_custkey % 20 <> 0 as active from customer where c_custkey % 10 = 0"


@query(f"with d as ({_DELTA}) select c_custkey, c_name, c_acctbal from customer where c_custkey not in (select c_custkey from d) union all select c_custkey, c_name, c_acctbal from d where active")
def q14_apply_delta(spark, sf_dir):
    """A batch of changes to every tenth customer; each second of these deletes."""
    customer = read(spark, sf_dir, "customer")
    delta = customer.filter("c_custkey % 10 = 0").withColumn("c_name", F.concat("c_name", F.lit("*"))).withColumn("active", F.expr("c_custkey % 20 <> 0"))
    return R.apply_delta(customer, delta, "c_custkey").select("c_custkey", "c_name", "c_acctbal")


@query(
    """with asked as (select p_partkey, p_name, split_part(p_name, ' ', 1) as lead, p_size from part), known as (select distinct p_name as full_name, split_part(p_name, ' ', 1) as lead from part where p_size <= 25),
    one as (select lead, min(full_name) as full_name from known group by lead having count(*) = 1)
    select p_partkey, case when k.full_name is not null then 'exact' when one.full_name is not null then 'lead' else 'none' end as how, coalesce(k.full_name, one.full_name) as found
    from asked left join known k on asked.p_name = k.full_name left join one on asked.lead = one.lead"""
)
def q15_exact_else_unique_lead(spark, sf_dir):
    part = read(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size", F.substring_index("p_name", " ", 1).alias("lead"))
    known = part.filter("p_size <= 25").select(F.col("p_name").alias("full_name"), "lead").distinct()
    one = R.unique_only(known, ["lead"], "full_name").withColumnRenamed("full_name", "lead_name")
    met = part.join(known.select("full_name"), part["p_name"] == F.col("full_name"), "left").join(one, "lead", "left")
    how = F.when(F.col("full_name").isNotNull(), "exact").when(F.col("lead_name").isNotNull(), "lead").otherwise("none")
    return met.select("p_partkey", how.alias("how"), F.coalesce("full_name", "lead_name").alias("found"))


@query("select p_partkey, array_to_string(list_sort(list_filter(string_split(trim(translate(lower(p_name || ' ' || p_brand), '#-', '  ')), ' '), lambda x: x <> '')), ' ') as name_key from part")
def q16_sorted_word_key(spark, sf_dir):
    text = F.translate(F.lower(F.concat_ws(" ", "p_name", "p_brand")), "#-", "  ")
    return read(spark, sf_dir, "part").select("p_partkey", S.sorted_words(text).alias("name_key"))


@query(
    """with n as (select distinct p_name as t from part), q as (select t, substr(t, 1, length(t) - 1) || 'X' as asked from n),
    m as (select q.asked, n.t as found, levenshtein(q.asked, n.t) as d from q join n on abs(length(q.asked) - length(n.t)) <= greatest(1, length(q.asked) // 5) where levenshtein(q.asked, n.t) <= greatest(1, length(q.asked) // 5)),
    b as (select asked, min(d) as d from m group by asked)
    select asked, min(found) as found, cast(min(m.d) as int) as d from m join b using (asked) where m.d = b.d group by asked having count(*) = 1"""
)
def q17_fuzzy_unique_minimum(spark, sf_dir):
    """Misspelt names looked up among the names that share a block of three letters; lengths differ by the allowed edits at most."""
    names = read(spark, sf_dir, "part").select(F.col("p_name").alias("found")).distinct()
    asked = names.select(F.concat(F.expr("substr(found, 1, length(found) - 1)"), F.lit("X")).alias("asked"))
    a = asked.withColumn("block", F.explode(R.blocks_of(F.col("asked"), 3)))
    b = names.withColumn("block", F.explode(R.blocks_of(F.col("found"), 3)))
    met = a.join(b, "block").filter("abs(length(asked) - length(found)) <= greatest(1, length(asked) div 5)").select("asked", "found").distinct()
    near = met.withColumn("d", F.levenshtein("asked", "found")).filter("d <= greatest(1, length(asked) div 5)")
    return R.nearest_unique(near, ["asked"], "d", "found").select("asked", "found", "d")


@query("select conv_id, turn, role from (select *, lag(role) over (partition by conv_id order by turn) as b from conversations) where b is null or b <> role")
def q18_adjacent_changes(spark, sf_dir):
    return R.adjacent_changes(read(spark, sf_dir, "conversations"), ["conv_id"], ["turn"], "role").select("conv_id", "turn", "role")


@query("select time_bucket(interval '5 minutes', ts) as start, event_type, count(*) as n, sum(value) / 300 as rate from events group by 1, 2")
def q19_throughput_window(spark, sf_dir):
    w = F.window("ts", "5 minutes")
    return read(spark, sf_dir, "events").groupBy(w.alias("w"), "event_type").agg(F.count("*").alias("n"), (F.sum("value") / 300).alias("rate")).select(F.col("w.start").cast("timestamp_ntz").alias("start"), "event_type", "n", "rate")


@query("select event_id, cast(json_extract(props, '$.k') as bigint) as k from events")
def q20_typed_json(spark, sf_dir):
    return read(spark, sf_dir, "events").select("event_id", F.from_json("props", "k bigint").getField("k").alias("k"))


@query("select page_id, cast(i - 1 as bigint) as pos, b as block from (select page_id, unnest(string_split(html, '<p>')) as b, generate_subscripts(string_split(html, '<p>'), 1) as i from pages)")
def q21_block_split(spark, sf_dir):
    return read(spark, sf_dir, "pages").select("page_id", F.posexplode(F.split("html", "<p>")).alias("pos", "block")).withColumn("pos", F.col("pos").cast("long"))


@query("select case when n_chars >= 5000 then 'long' when n_chars >= 500 then 'middle' when n_chars >= 50 then 'short' else 'stub' end as level, count(*) as n, count(*) filter (where lang = 'en') as n_en from documents group by 1")
def q22_bucket_counters(spark, sf_dir):
    level = F.when(F.col("n_chars") >= 5000, "long").when(F.col("n_chars") >= 500, "middle").when(F.col("n_chars") >= 50, "short").otherwise("stub")
    return read(spark, sf_dir, "documents").groupBy(level.alias("level")).agg(F.count("*").alias("n"), F.count_if(F.col("lang") == "en").alias("n_en"))


@query("select l_orderkey, count(*) as n from lineitem where exists (select 1 from orders where o_orderkey = l_orderkey and o_orderpriority = '1-URGENT') group by 1")
def q23_semi_join(spark, sf_dir):
    urgent = read(spark, sf_dir, "orders").filter("o_orderpriority = '1-URGENT'").select(F.col("o_orderkey").alias("l_orderkey"))
    return read(spark, sf_dir, "lineitem").join(urgent, "l_orderkey", "left_semi").groupBy("l_orderkey").agg(F.count("*").alias("n"))


@query("select n_name as term, cast(m as date) as month from nation, range(date '2024-01-01', date '2025-01-01', interval 1 month) t(m)")
def q24_job_grid(spark, sf_dir):
    """Search terms by months: each row gets its twelve jobs, no join."""
    months = F.sequence(S.month(F.lit("01.2024")), S.month(F.lit("12.2024")), F.expr("interval 1 month"))
    return read(spark, sf_dir, "nation").select(F.col("n_name").alias("term"), F.explode(months).alias("month"))


@query(
    """select l_orderkey, array_to_string(list(l_partkey order by l_linenumber, l_partkey), ',') as parts, array_to_string(list(coalesce(nullif(l_returnflag, 'N'), '-') order by l_linenumber, l_partkey, nullif(l_returnflag, 'N') nulls first), ',') as flags
    from lineitem where l_discount > 0 group by 1"""
)
def q25_parallel_arrays(spark, sf_dir):
    """Lines without a discount count as unusable and leave every array."""
    item = F.struct("l_linenumber", "l_partkey", F.nullif("l_returnflag", F.lit("N")).alias("flag"), F.nullif(F.col("l_discount"), F.lit(0.0)).alias("discount"))
    rows = read(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.sort_array(F.collect_list(item)).alias("items"))
    flat = R.parallel_arrays(F.col("items"), "discount", {"l_partkey": None, "flag": "-"})
    out = rows.select("l_orderkey", *[c.alias(n) for n, c in flat.items()]).filter("size(flag) > 0")
    return out.select("l_orderkey", F.array_join(F.col("l_partkey").cast("array<string>"), ",").alias("parts"), F.array_join("flag", ",").alias("flags"))


@query(
    """select doc_id, case when length(c) > 300 then substr(c, 1, 300) || '...' else c end as cleaned
    from (select doc_id, regexp_replace(regexp_replace(regexp_replace(text, '[ \\t\\r\\n]+', ' ', 'g'), ' ([,.;])', '\\1', 'g'), '^[ ,;]+|[ ,;]+$', '', 'g') as c from documents)"""
)
def q26_clean_chain(spark, sf_dir):
    text = rewrite(F.col("text"), [(r"[ \t\r\n]+", " "), (r" ([,.;])", "$1"), (r"^[ ,;]+|[ ,;]+$", "")], unicode=False)
    return read(spark, sf_dir, "documents").select("doc_id", F.when(F.char_length(text) > 300, F.concat(F.substring(text, 1, 300), F.lit("..."))).otherwise(text).alias("cleaned"))


@query("select o_orderkey, o_totalprice, rank() over w as place, count(*) over (partition by o_custkey, o_totalprice) as ties from orders window w as (partition by o_custkey order by o_totalprice) qualify place = 1")
def q27_least_with_ties(spark, sf_dir):
    w = Window.partitionBy("o_custkey").orderBy("o_totalprice")
    ties = F.count("*").over(Window.partitionBy("o_custkey", "o_totalprice"))
    return read(spark, sf_dir, "orders").withColumn("ties", ties).withColumn("place", F.rank().over(w)).filter("place = 1").select("o_orderkey", "o_totalprice", "place", "ties")


@query("select (select count(*) from pages) as n_pages, (max(n) - 0) as widest, sum(n) as expected from (select lang, count(*) as n from documents group by lang)")
def q28_expected_counts(spark, sf_dir):
    n = read(spark, sf_dir, "documents").groupBy("lang").count().agg(F.max("count").alias("widest"), F.sum("count").alias("expected"))
    return read(spark, sf_dir, "pages").agg(F.count("*").alias("n_pages")).crossJoin(F.broadcast(n))


@query("select source, count(*) as hits, max(n_chars) as most, max_by(doc_id, (n_chars, doc_id)) as worst from documents group by source")
def q29_worst_by_group(spark, sf_dir):
    return read(spark, sf_dir, "documents").groupBy("source").agg(F.count("*").alias("hits"), F.max("n_chars").alias("most"), F.max_by("doc_id", F.struct("n_chars", "doc_id")).alias("worst"))


@query("select lang, source, sum(n)::bigint as n, max(first_seen) as first_seen from (select lang, source, count(*) as n, min(doc_id) as first_seen from documents where doc_id % 2 = 0 group by all union all select lang, source, count(*), min(doc_id) from documents where doc_id % 2 = 1 group by all) group by all")
def q30_union_of_volumes(spark, sf_dir):
    """Two volumes united; a key that both have is counted together."""
    docs = read(spark, sf_dir, "documents")
    parts = [docs.filter(f"doc_id % 2 = {k}").groupBy("lang", "source").agg(F.count("*").alias("n"), F.min("doc_id").alias("first_seen")) for k in (0, 1)]
    return parts[0].unionByName(parts[1]).groupBy("lang", "source").agg(F.sum("n").alias("n"), F.max("first_seen").alias("first_seen"))
