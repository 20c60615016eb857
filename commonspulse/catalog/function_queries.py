"""Scalar expressions over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from commonspulse.catalog.adapter import base, cte, ntz, view
from commonspulse.catalog.registry import query
from commonspulse.functions import expressions as X


@query("fn_string", """
with t as (select p_partkey, concat('--', p_name, ' _', p_brand, '__', p_type, '-') as s from part),
u as (select *, trim(regexp_replace(lower(s), '[^a-z0-9-]+', '-', 'g'), '-') as safe from t)
select p_partkey, safe as safe_login, substring(concat(safe, '__'), 1, 2) as shard,
  replace(lower(regexp_extract(trim(p_name || '_Pkg>=1'), '^[A-Za-z0-9_.-]+')), '_', '-') as package_name,
  starts_with(lower(p_brand), 'brand#1') as prefixed, regexp_matches(p_type, 'ECO|PROMO') as matched,
  concat(coalesce(p_name, ''), ' ', coalesce(p_type, '')) as text
from u join part using (p_partkey)""")
def strings(spark, sf_dir):
    login = F.concat(F.lit("--"), "p_name", F.lit(" _"), "p_brand", F.lit("__"), "p_type", F.lit("-"))
    safe = X.safe_login(login)
    return base(spark, sf_dir, "part").select(
        "p_partkey", safe.alias("safe_login"), X.shard_of(safe).alias("shard"),
        X.package_name(F.concat(F.col("p_name"), F.lit("_Pkg>=1"))).alias("package_name"),
        F.lower("p_brand").startswith("brand#1").alias("prefixed"), F.col("p_type").rlike("ECO|PROMO").alias("matched"),
        F.concat(F.coalesce("p_name", F.lit("")), F.lit(" "), F.coalesce("p_type", F.lit(""))).alias("text"))


@query("fn_conditional", cte("repository") + """
select repo_id, case when is_fork then 'forked' else 'original' end as origin, cast(is_fork as int) as fork_dummy,
  coalesce(setup_py_present, false) as present, coalesce(license_spdx, 'none') as license from repository""")
def conditionals(spark, sf_dir):
    return view(spark, sf_dir, "repository").select(
        "repo_id", F.when(F.col("is_fork"), "forked").otherwise("original").alias("origin"),
        X.flag(F.col("is_fork")).alias("fork_dummy"), F.coalesce("setup_py_present", F.lit(False)).alias("present"),
        F.coalesce("license_spdx", F.lit("none")).alias("license"))


@query("fn_cast", """
with t as (select p_partkey, case p_size % 5 when 0 then concat(' ', cast(p_size as varchar), ' ') when 1 then concat(cast(p_size as varchar), '.0')
  when 2 then '' when 3 then concat(cast(p_size as varchar), repeat('0', 20)) else concat('-', cast(p_size as varchar)) end as s from part)
select p_partkey, case when regexp_full_match(trim(s), '[+-]?[0-9]{1,18}') then cast(trim(s) as bigint) end as number from t""")
def casts(spark, sf_dir):
    size = F.col("p_size")
    text = (
        F.when(size % 5 == 0, F.concat(F.lit(" "), size, F.lit(" "))).when(size % 5 == 1, F.concat(size, F.lit(".0")))
        .when(size % 5 == 2, "").when(size % 5 == 3, F.concat(size, F.lit("0" * 20))).otherwise(F.concat(F.lit("-"), size))
    )
    return base(spark, sf_dir, "part").select("p_partkey", X.as_bigint(text).alias("number"))


@query("fn_date", """
select l_orderkey, l_linenumber, l_partkey, cast(date_trunc('month', l_shipdate) as date) as month,
  strftime(l_shipdate, '%Y-%m') as month_text, cast(l_shipdate as timestamp) as parsed from lineitem""")
def dates(spark, sf_dir):
    moment = F.col("l_shipdate").cast("timestamp")
    iso = F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ssXXX")
    return base(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", X.month_of(moment).alias("month"),
        X.month_text(moment).alias("month_text"), F.to_timestamp(iso).cast("timestamp_ntz").alias("parsed"))


@query("fn_math", """
select l_orderkey, count(*) as n, round(ln(1 + count(*)), 9) as log_count, cast(count(*) > 4 as int) as many from lineitem group by 1""")
def math(spark, sf_dir):
    counts = base(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"))
    return counts.select("l_orderkey", "n", F.round(X.log_plus_one(F.col("n")), 9).alias("log_count"),
                         X.dummy(F.col("n") > 4).alias("many"))


@query("fn_json", cte("raw_event") + """
select event_id, repo_id, created_at,
  case when json_type(payload, '$.action') not in ('OBJECT', 'ARRAY') then json_extract_string(payload, '$.action') end as action,
  json_extract_string(payload, '$.forkee.owner.id') as owner, json_extract_string(payload, '$.pull_request.merged') as merged,
  case when json_type(payload, '$.commits') = 'ARRAY' then cast(json_array_length(payload, '$.commits') as int) end as commits
from raw_event""")
def json_paths(spark, sf_dir):
    rows = X.json_scalars(view(spark, sf_dir, "raw_event"), "payload", action="$.action",
                          owner="$.forkee.owner.id", merged="$.pull_request.merged")
    return rows.select("event_id", "repo_id", ntz("created_at"), "action", "owner", "merged",
                       X.json_array_size(F.col("payload"), "$.commits").alias("commits"))


@query("fn_json_text", """
select s_suppkey, cast(to_json({'id': s_suppkey, 'login': case when s_acctbal >= 0 then concat('Ünï-', s_name) end}) as varchar) as body
from supplier""")
def json_text(spark, sf_dir):
    login = F.when(F.col("s_acctbal") >= 0, F.concat(F.lit("Ünï-"), "s_name"))
    body = F.to_json(F.struct(F.col("s_suppkey").alias("id"), login.alias("login")), {"ignoreNullFields": "false"})
    return base(spark, sf_dir, "supplier").select("s_suppkey", body.alias("body"))


@query("fn_array", """
select p_partkey, role, value from (
  select p_partkey, 'name' as role, p_name as value from part union all
  select p_partkey, 'brand', case when p_size % 2 = 0 then lower(p_brand) end from part) x where value is not null""")
def arrays(spark, sf_dir):
    brand = F.when(F.col("p_size") % 2 == 0, F.lower("p_brand"))
    pairs = F.array(F.struct(F.lit("name").alias("role"), F.col("p_name").alias("value")),
                    F.struct(F.lit("brand").alias("role"), brand.alias("value")))
    return base(spark, sf_dir, "part").select("p_partkey", F.inline(F.filter(pairs, lambda p: p["value"].isNotNull())))


@query("fn_codec", "select doc_id, text from documents")
def codec(spark, sf_dir):
    encoded = F.base64(F.col("text").cast("binary"))
    return base(spark, sf_dir, "documents").select("doc_id", X.decode_base64_text(encoded).alias("text"))
