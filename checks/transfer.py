"""Sources and sinks: the given tables written in the form a source has, read back, conformed and compared."""

from __future__ import annotations

import warnings

from pyspark.sql import functions as F

from wardline import registry as REG
from wardline.operators import balanced as B
from wardline.operators import conform as CF
from wardline.operators import joins as J
from wardline.operators import ordered as O
from wardline.operators import profile as PR
from wardline.sources import readers as RD
from wardline.sources import writers as WR
from wardline.sources.folders import scratch_folder

from .base import Tables, check
from .profiling import labelled
from .shaping import rounded

REMARK = """case when o_orderkey % 5 = 0 then null when o_orderkey % 5 = 1 then 'say "' || o_orderpriority || '", twice' else o_orderpriority end"""


@check("single_csv", "SNK2 SRC3 SCH1 SCH3 SRT1", f"""
select o_orderkey::double as o_orderkey, o_orderstatus, o_totalprice, case when o_orderkey % 3 > 0 then (o_custkey % 100)::double end as age, {REMARK} as remark
from orders""")
def single_csv(spark, d):
    """One gzip file in key order, written in parallel, read as text and typed."""
    path = scratch_folder(spark, "registry") + ".csv.gz"
    orders = Tables(spark, d).orders.selectExpr(
        "o_orderkey as O_ORDERKEY", "o_orderstatus as O_ORDERSTATUS", "o_totalprice as O_TOTALPRICE",
        "case when o_orderkey % 3 > 0 then cast(o_custkey % 100 as string) else 'n/a' end as Age", f"{REMARK} as Remark")
    WR.write_single_csv(orders, path, ["O_ORDERKEY"])
    return RD.read_registry_csv(spark, path, ["o_orderkey", "o_totalprice", "age"], partitions=8)


@check("repaired_header", "SCH2 SRC4 SCH1", """
select c_custkey::varchar as site_id, c_mktsegment as unit, c_acctbal as weight from customer""")
def repaired_header(spark, d):
    """A sheet export whose first name carries a byte-order mark, every column as text, typed afterwards."""
    path = scratch_folder(spark, "sheet")
    sheet = Tables(spark, d).customer.selectExpr("c_custkey", "c_mktsegment as Unit", "c_acctbal as Weight").withColumnRenamed(
        "c_custkey", "ï»¿SITE_ID")
    WR.write_csv(sheet, path, gzip=False)
    return RD.read_registry_csv(spark, path, ["weight"], "site_id")


@check("code_map_file", "SRC7 JON10", """
select s_suppkey, n_name || ', "' || r_name || '"' as place, n_nationkey + 0.5::double as weight from supplier
join nation on s_nationkey = n_nationkey join region on n_regionkey = r_regionkey""")
def code_map_file(spark, d):
    """A code map as a quoted file; codes keep their shape as text, weights become numbers."""
    t = Tables(spark, d)
    path = scratch_folder(spark, "codes")
    codes = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).selectExpr(
        "n_nationkey || '.10' as code", """n_name || ', "' || r_name || '"' as place""", "n_nationkey + 0.5D as weight")
    codes.write.option("header", True).option("quoteAll", True).option("escape", '"').csv(path)
    coded = t.supplier.selectExpr("s_suppkey", "s_nationkey || '.10' as code")
    return J.lookup(coded, RD.read_map(spark, path, ["weight"]), {"code": "code"}, {"place": "place", "weight": "weight"}).drop("code")


@check("code_dictionary_file", "SRC7 JON11", """
select o_orderkey, o_orderpriority || '; as ordered' as description from orders where o_orderkey % 2 = 0""")
def code_dictionary_file(spark, d):
    """A headerless dictionary of the codes that occur."""
    t = Tables(spark, d)
    path = scratch_folder(spark, "dictionary")
    t.orders.selectExpr("substring(o_orderpriority, 1, 1) || '.01' as c", "o_orderpriority || '; as ordered' as t").distinct().write.option(
        "quoteAll", True).csv(path)
    coded = t.orders.where("o_orderkey % 2 = 0").selectExpr("o_orderkey", "substring(o_orderpriority, 1, 1) || '.01' as code")
    return J.lookup(coded, RD.read_dictionary(spark, path), {"code": "code"}, {"description": "description"}).drop("code")


@check("registry_file", "SRC6 SCH8", """
select lower(n_name) as varname, case r_name when 'ASIA' then 'labs' when 'EUROPE' then 'vitals' when 'AFRICA' then 'demographic' else r_name end as category,
  'numeric' as "dataType", if(n_nationkey % 2 = 0, 'kg', null) as unitofmeasure, n_nationkey::varchar as low, if(n_nationkey % 3 = 0, 'Yes', 'No') as imputation,
  row_number() over (order by case r_name when 'AFRICA' then 2 when 'EUROPE' then 4 when 'ASIA' then 5 else 99 end, lower(n_name)) as place
from nation join region on n_regionkey = r_regionkey""")
def registry_file(spark, d):
    """A variable registry as a file of nested records, read into one row per variable, in printing order."""
    t = Tables(spark, d)
    path = scratch_folder(spark, "variables")
    category = "case r_name when 'ASIA' then 'labs' when 'EUROPE' then 'vitals' when 'AFRICA' then 'demographic' else r_name end"
    record = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).selectExpr(
        "lower(n_name) as name", f"""named_struct('category', {category}, 'dataType', 'numeric', 'imputation', n_nationkey % 3 = 0,
          'unitofmeasure', if(n_nationkey % 2 = 0, 'kg', 'None'), 'permissibleRange', named_struct('low', n_nationkey, 'coded', 'None')) as rec""")
    whole = record.agg(F.to_json(F.map_from_entries(F.collect_list(F.struct("name", "rec")))).alias("value"))
    whole.write.text(path)
    defs = REG.definitions(RD.read_registry(spark, path))
    numbered = B.sequence(defs, [], [O.nulls_last(REG.category_rank()), F.col("varname")], "place")
    return numbered.select("varname", "category", "dataType", "unitofmeasure", "permissibleRange.low", "imputation", "place")


@check("header_file", "SRC5 SCH9", """
select lower(c_name) as name, row_number() over (order by c_custkey) as place from customer where c_custkey <= (select count(*) from nation)""")
def header_file(spark, d):
    """An ordered list of names as a file, made from definitions with gaps and capitals, read in its order."""
    t = Tables(spark, d)
    path = scratch_folder(spark, "header")
    n = t.nation.agg(F.count("*").alias("n")).scalar()
    defs = t.customer.select("c_custkey", F.when(F.col("c_custkey") <= n, F.col("c_name")).alias("varname"))
    REG.header_of(defs.orderBy("c_custkey")).coalesce(1).write.text(path)
    return spark.createDataFrame([(n, i + 1) for i, n in enumerate(RD.read_header(spark, path))], "name string, place long")


EXTRACT = ["data_source", "encounter_id", "age", "gender", "apache_3j_diagnosis", "d1_wbc_max", "hospital_death", "weight"]


@check("extract_files", "SNK2 SRC3 SCH6", """
select 'north' as data_source, o_orderkey::varchar as encounter_id, (o_custkey % 90)::double as age, if(o_orderkey % 2 = 0, 'F', null) as gender,
  (o_custkey % 7) || '.10' as apache_3j_diagnosis, o_totalprice as d1_wbc_max, (o_orderstatus = 'F')::integer as hospital_death, null::double as weight from orders""")
def extract_files(spark, d):
    """The harmonised row as gzip files in parallel, read under the typed header; diagnosis codes keep their zeros."""
    path = scratch_folder(spark, "extract")
    rows = Tables(spark, d).orders.selectExpr(
        "'north' as data_source", "o_orderkey as encounter_id", "o_custkey % 90 as age", "if(o_orderkey % 2 = 0, 'F', null) as gender",
        "(o_custkey % 7) || '.10' as apache_3j_diagnosis", "o_totalprice as d1_wbc_max", "cast(o_orderstatus = 'F' as int) as hospital_death")
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        WR.write_csv(CF.conform(rows, REG.header_schema(EXTRACT)), path)
    return RD.read_extract(spark, path, EXTRACT)


@check("category_files", "SNK3 AGG19", """
with c as (select lang, variable, percent, if(variable in ('quality', 'toxic'), 'label', 'text') as category from (
  select lang, round(count(source) * 100.0 / count(*), 4) as source, round(count(n_chars) * 100.0 / count(*), 4) as n_chars,
    round(nullif(count(quality) * 100.0 / count(*), 0), 4) as quality, round(nullif(count(toxic) * 100.0 / count(*), 0), 4) as toxic
  from documents d left join labels l on d.doc_id = l.doc_id group by 1) unpivot include nulls (percent for variable in (source, n_chars, quality, toxic)))
select lang, variable, percent, category from c""")
def category_files(spark, d):
    """One folder of files per category of a completeness table, read as one table again."""
    path = scratch_folder(spark, "completion")
    table = rounded(PR.completion(labelled(Tables(spark, d)), ["source", "n_chars", "quality", "toxic"], "lang"))
    WR.write_by_category(table.withColumn("category", F.when(F.col("variable").isin("quality", "toxic"), "label").otherwise("text")), path)
    return spark.read.schema("lang string, variable string, percent double, category string").option("header", True).csv(path)


@check("published_table", "SNK1 SRC1", """
select o_custkey, count(*) + 1 as n, round(sum(o_totalprice), 2) as spent from orders group by 1""")
def published_table(spark, d):
    """A table that is replaced by a query over itself, twice, and read through its manifest."""
    path = scratch_folder(spark, "published")
    WR.publish(Tables(spark, d).orders.select("o_custkey", "o_totalprice"), path)
    rows = RD.read_published(spark, path)
    WR.publish(rows.groupBy("o_custkey").agg(F.count("*").alias("n"), F.sum("o_totalprice").alias("spent")), path)
    WR.publish(RD.read_published(spark, path).select("o_custkey", F.col("n") + 1, F.round("spent", 2).alias("spent")).toDF("o_custkey", "n", "spent"), path)
    return RD.read_published(spark, path)


@check("members_file", "SRC1 SRC3 SNK2", """
select o_orderkey, o_custkey, o_totalprice from orders where o_orderkey between 1000 and 9000""")
def members_file(spark, d):
    """One gzip file read in ranges: typed columns, pruned ones left out, members without a match never opened."""
    path = scratch_folder(spark, "members") + ".csv.gz"
    WR.write_single_csv(Tables(spark, d).orders.select("o_orderkey", "o_custkey", "o_orderpriority", "o_totalprice"), path, ["o_orderkey"], 16, index=True)
    return RD.read_members(spark, path, "o_orderkey long, o_custkey long, o_totalprice double").where("o_orderkey between 1000 and 9000")
