"""Variable registries, lookups, texts, and the simulation catalogue's plans."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import names
from ..operators import registry as reg
from ..operators import select
from ..plans import windows
from ..sources import sinks, tables
from .views import CATALOG, REGISTRY, at, catalog, register, registry, table

QUERIES: dict = {}
ORACLES: dict[str, str] = {}
query = register(QUERIES, ORACLES)
KEY = ("target_var", "family", "level", "run_type")


@query("s09_registry_problems", f"WITH {REGISTRY} SELECT target_var, family, level, run_type, count(*) AS n FROM registry GROUP BY ALL HAVING count(*) > 1")
def s09(spark, d):
    return reg.repeated_keys(reg.trimmed(registry(spark, d)), *KEY)


@query("s10_without_blanks", f"WITH {REGISTRY}, b AS (SELECT p_partkey, CASE WHEN size % 5 = 0 THEN '  ' ELSE target_var || ' ' END AS var_name, CASE WHEN size % 7 = 0 THEN NULL ELSE source_var END AS source_var FROM registry) SELECT p_partkey, trim(var_name) AS var_name, source_var FROM b WHERE trim(var_name) <> '' AND trim(source_var) <> ''")
def s10(spark, d):
    x = registry(spark, d).select("p_partkey", F.when(F.col("size") % 5 == 0, "  ").otherwise(F.concat("target_var", F.lit(" "))).alias("var_name"), F.when(F.col("size") % 7 != 0, F.col("source_var")).alias("source_var"))
    return reg.without_blanks(x, "var_name", "source_var")


@query("j07_registry_lookup", f"WITH {REGISTRY}, u AS (SELECT target_var, family, level, run_type, min(source_var) AS source_var FROM registry GROUP BY ALL), s AS (SELECT DISTINCT target_var, family, level, run_type FROM registry) SELECT s.*, u.source_var FROM s JOIN u USING (target_var, family, level, run_type)")
def j07(spark, d):
    r = registry(spark, d)
    unique = r.groupBy(*KEY).agg(F.min("source_var").alias("source_var"))
    return reg.resolve(r.select(*KEY).distinct(), unique)


@query("j08_group_lookup", f"WITH {REGISTRY}, r AS (SELECT target_var AS var_name, source_var, CASE size % 4 WHEN 0 THEN '' WHEN 1 THEN 'sl' WHEN 2 THEN 'any' ELSE 'pl' END AS grp FROM registry), q AS (SELECT DISTINCT target_var AS var_name, unnest(['sl', 'pl']) AS grp FROM registry) SELECT q.var_name, q.grp, max(r.source_var) AS source_var, count(DISTINCT r.source_var) AS n FROM q JOIN r ON q.var_name = r.var_name AND (r.grp IN ('', 'any', 'all') OR r.grp = q.grp) GROUP BY ALL")
def j08(spark, d):
    x = registry(spark, d)
    k = F.col("size") % 4
    r = x.select(F.col("target_var").alias("var_name"), "source_var", F.when(k == 0, "").when(k == 1, "sf").when(k == 2, "any").otherwise("pl").alias("grp"))
    q = x.select(F.col("target_var").alias("var_name")).distinct().withColumn("grp", F.explode(F.array(F.lit("sf"), F.lit("pl"))))
    return reg.group_lookup(q, r)


@query("j09_source_name", f"WITH {REGISTRY} SELECT p_partkey, coalesce(CASE WHEN size % 11 = 0 THEN 'explicit' END, CASE WHEN size % 3 = 0 THEN source_var END, CASE WHEN size % 2 = 0 THEN lower(family) END, target_var) AS source FROM registry")
def j09(spark, d):
    s = F.col("size")
    e, m, f = F.when(s % 11 == 0, "explicit").otherwise(" "), F.when(s % 3 == 0, F.col("source_var")), F.when(s % 2 == 0, F.lower("family"))
    return registry(spark, d).select("p_partkey", reg.source_name(e, m, f, F.col("target_var")).alias("source"))


DOCS = REGISTRY + """, docs AS (SELECT p_partkey AS doc_id, level AS documented_level, source_var, run_type AS analysis_or_forecast, 'about ' || long_name AS about FROM registry),
x AS (SELECT doc_id, documented_level, source_var, about, analysis_or_forecast, unnest(CASE analysis_or_forecast WHEN 'both' THEN ['anl', 'fcst'] ELSE [analysis_or_forecast] END) AS run_type FROM docs),
r AS (SELECT level, source_var, run_type, count(*) AS n, string_agg(DISTINCT family, ',' ORDER BY family) AS fam, string_agg(DISTINCT level, ',' ORDER BY level) AS lev FROM registry GROUP BY ALL)"""


@query("j10_documented", f"WITH {DOCS} SELECT CAST(doc_id AS VARCHAR) AS doc_id, x.source_var, x.run_type, coalesce(n, 0) AS matched, coalesce(fam, '') AS families, coalesce(lev, '') AS levels, about, analysis_or_forecast AS stated FROM x LEFT JOIN r ON x.documented_level = r.level AND x.source_var = r.source_var AND x.run_type = r.run_type")
def j10(spark, d):
    r = registry(spark, d)
    docs = r.select(F.col("p_partkey").alias("doc_id"), F.col("level").alias("documented_level"), "source_var", F.col("run_type").alias("analysis_or_forecast"), F.concat(F.lit(" about  "), "long_name").alias("documented_long_name"))
    x = reg.documented(docs, r)
    return x.select("doc_id", "source_var", "run_type", F.col("matched_source_registry_rows").alias("matched"), F.col("matched_families").alias("families"), F.col("matched_registry_levels").alias("levels"), F.col("documented_long_name").alias("about"), F.col("analysis_or_forecast").alias("stated"))


ATTRS = REGISTRY + """, a AS (SELECT p_partkey, family, level, source_var, run_type, CAST(size % 4 AS INTEGER) AS rank, target_var AS name, size FROM registry)"""


def _attrs(spark, d):
    """Arrays of an archive by the size of a part: attributes as text, shape and chunks; every fourth names its dimensions."""
    s, k = F.col("size") % 3, F.col("size") % 4
    named = F.when(k == 3, '"_ARRAY_DIMENSIONS": ["time", "y", "x"], ').otherwise("")
    text = (
        F.when(s == 0, F.concat(F.lit("{"), named, F.lit('"short_name": "'), "target_var", F.lit('", "units": "m", "long_name": " ", "GRIB_name": "by GRIB"}')))
        .when(s == 1, F.concat(F.lit("{"), named, F.lit('"GRIB_cfVarName": " ", "GRIB_units": "K", "long_name": "Orography of '), "target_var", F.lit('"}')))
        .otherwise(F.concat(F.lit("{"), named, F.lit('"long_name": "x", "GRIB_cfName": "std", "coordinates": "lat lon", "GRIB_shortName": "sn"}')))
    )
    text = F.when(F.col("p_partkey") % 13 == 0, "{not readable").otherwise(text)
    shape = F.transform(F.sequence(F.lit(1), k), lambda i: i.cast("int") * 10)
    shape = F.when(k == 0, F.array().cast("array<int>")).otherwise(shape)
    return registry(spark, d).select(
        "p_partkey", "family", "level", "source_var", "run_type", text.alias("attrs"), F.lit("root").alias("root"), shape.alias("shape"),
        F.transform(shape, lambda i: (i / 10).cast("int")).alias("chunks"), F.lit("<f4").alias("dtype"), "size",
    )


DISCOVERED = """SELECT p_partkey % 13 = 0 AS bad, p_partkey, family, level, source_var, run_type, size,
  CASE size % 3 WHEN 0 THEN name WHEN 1 THEN source_var ELSE 'sn' END AS target, CASE size % 3 WHEN 0 THEN 'by GRIB' WHEN 1 THEN 'Orography of ' || name ELSE 'x' END AS ln,
  CASE size % 3 WHEN 0 THEN 'm' WHEN 1 THEN 'K' ELSE '' END AS un,
  CASE WHEN rank = 3 THEN 'time,y,x' WHEN run_type = 'anl' AND rank = 2 THEN 'y,x' WHEN rank = 1 THEN 'dim_0' WHEN rank = 2 THEN 'dim_0,dim_1' ELSE '' END AS di, rank, name FROM a"""


@query("s15_discover_registry", f"""WITH {ATTRS}, x AS ({DISCOVERED})
SELECT CASE WHEN bad THEN '' ELSE target END AS target_var, CASE WHEN bad THEN '' ELSE ln END AS long_name, CASE WHEN bad THEN '' ELSE un END AS units, family, level, source_var, run_type AS mode,
  CASE WHEN bad OR size % 3 = 1 THEN '0' ELSE '1' END AS include_in_cli, CASE WHEN bad THEN 'Failed to read attributes' ELSE '' END AS notes, run_type, source_var AS variable,
  CASE WHEN bad THEN '' WHEN size % 3 = 0 THEN name WHEN size % 3 = 2 THEN 'sn' ELSE '' END AS short_name, '' AS cf_var_name, CASE WHEN NOT bad AND size % 3 = 2 THEN 'std' ELSE '' END AS standard_name,
  CASE WHEN NOT bad AND size % 3 = 2 THEN 'lat lon' ELSE '' END AS coordinates, CASE WHEN bad THEN '' ELSE di END AS dims,
  CASE WHEN bad THEN '' ELSE ['[]', '[10]', '[10,20]', '[10,20,30]'][1 + rank] END AS shape, CASE WHEN bad THEN '' ELSE ['[]', '[1]', '[1,2]', '[1,2,3]'][1 + rank] END AS chunks,
  CASE WHEN bad THEN '' ELSE '<f4' END AS dtype, CASE WHEN bad THEN '' ELSE CAST(rank AS VARCHAR) END AS ndim,
  'root/' || level || '/' || source_var AS group_path, 'root/' || level || '/' || source_var || '/' || level AS array_group, 'root/' || level || '/' || source_var || '/' || level || '/' || source_var AS array_path,
  CASE WHEN bad THEN '' WHEN size % 3 = 0 THEN '{{"GRIB_name":"by GRIB","long_name":" ","short_name":"' || name || '","units":"m"}}' WHEN size % 3 = 1 THEN '{{"GRIB_cfVarName":" ","GRIB_units":"K","long_name":"Orography of ' || name || '"}}'
    ELSE '{{"GRIB_cfName":"std","GRIB_shortName":"sn","coordinates":"lat lon","long_name":"x"}}' END AS attrs_json FROM x""")
def s15(spark, d):
    return reg.discover(_attrs(spark, d))


@query("f18_first_attribute", f"WITH {ATTRS} SELECT p_partkey, CASE WHEN p_partkey % 13 = 0 THEN source_var WHEN size % 3 = 0 THEN name WHEN size % 3 = 2 THEN 'sn' ELSE source_var END AS target_var FROM a")
def f18(spark, d):
    return _attrs(spark, d).select("p_partkey", names.target_var(F.col("attrs"), F.col("source_var")).alias("target_var"))


@query("f15_clean_text", f"WITH {REGISTRY} SELECT p_partkey, family || ' ' || target_var AS text, replace(level, '#', '_above_') AS level FROM registry")
def f15(spark, d):
    r = registry(spark, d)
    dirty = F.concat(F.lit("  "), "family", F.lit("  \t"), "target_var", F.lit("\n"))
    level = F.concat(F.lit(" "), F.replace("level", F.lit("#"), F.lit("_Above_")))
    return r.select("p_partkey", names.clean_text(dirty).alias("text"), names.normal_level(level).alias("level"))


@query("f17_expand_modes", f"WITH {REGISTRY} SELECT p_partkey, unnest(CASE run_type WHEN 'both' THEN ['anl', 'fcst'] ELSE [run_type] END) AS run_type FROM registry")
def f17(spark, d):
    return registry(spark, d).select("p_partkey", F.explode(names.modes(F.concat(F.lit(" "), F.upper("run_type")))).alias("run_type"))


@query("f20_offered", f"WITH {REGISTRY} SELECT p_partkey, CASE WHEN size % 9 = 0 THEN 0 ELSE 1 END AS offered FROM registry")
def f20(spark, d):
    long_name = F.when(F.col("size") % 9 == 0, "Geopotential Height at level").otherwise(F.col("long_name"))
    return registry(spark, d).select("p_partkey", names.offered(F.col("target_var"), F.col("source_var"), long_name).alias("offered"))


@query("f21_json", f"WITH {REGISTRY} SELECT p_partkey, '{{\"family\":\"' || family || '\",\"size\":' || size || '}}' AS attrs FROM registry")
def f21(spark, d):
    return registry(spark, d).select("p_partkey", F.to_json(F.struct("family", "size")).alias("attrs"))


@query("f22_paths", "SELECT o_orderkey, 'archive/' || o_orderpriority || '/' || strftime(o_orderdate, '%Y%m%d') || '/' || strftime(o_orderdate, '%Y%m%d') || '_' || strftime(o_orderdate, '%H') || 'z_anl.zarr' AS path FROM orders")
def f22(spark, d):
    return table(spark, d, "orders").select("o_orderkey", names.archive_path(F.col("o_orderpriority"), F.col("o_orderdate"), F.lit("anl")).alias("path"))


@query("f23_truthy", f"WITH {REGISTRY} SELECT p_partkey, size % 6 IN (0, 1, 2, 3) AS flag FROM registry")
def f23(spark, d):
    text = F.element_at(F.array(*map(F.lit, (" Yes", "TRUE", "1 ", "y", "no", ""))), (F.col("size") % 6 + 1).cast("int"))
    return registry(spark, d).select("p_partkey", names.truthy(text).alias("flag"))


@query("s18_first_data_variable", f"WITH {REGISTRY} SELECT p_partkey, CASE WHEN size % 2 = 0 THEN source_var ELSE 'lat_name' END AS name FROM registry")
def s18(spark, d):
    listed = F.when(F.col("size") % 2 == 0, F.array(F.lit("time"), F.lit("latitude"), F.col("source_var"))).otherwise(F.array(F.lit("time"), F.lit("lat_name"), F.col("source_var")))
    return registry(spark, d).select("p_partkey", reg.first_data_name(listed, "time", "latitude", "longitude").alias("name"))


@query("s27_variable_blocks", f"WITH {REGISTRY} SELECT source_var || '_' || p_partkey AS var, long_name AS description, family AS long_name, '' AS units FROM registry")
def s27(spark, d):
    r = registry(spark, d).select(F.concat_ws("_", "source_var", "p_partkey").alias("var"), F.col("long_name").alias("description"), F.col("family").alias("long_name"), F.lit("").alias("units"))
    path = sinks.scratch(spark, "blocks")
    sinks.write_descriptions(r, path)
    return tables.description_blocks(spark, path)


@query("p15_infer_group", f"WITH {REGISTRY} SELECT p_partkey, CASE size % 3 WHEN 0 THEN 'ml' WHEN 1 THEN 'pl' ELSE 'sl' END AS grp FROM registry")
def p15(spark, d):
    s = F.col("size") % 3
    dims = F.when(s == 0, F.array(F.lit("time"), F.lit("hybrid"))).when(s == 1, F.array(F.lit("level"), F.lit("x"))).otherwise(F.array(F.lit("time"), F.lit("y")))
    return registry(spark, d).select("p_partkey", select.infer_group(dims).alias("grp"))


@query("p22_variable_lists", f"WITH {REGISTRY} SELECT p_partkey, array_to_string(list_distinct_in_order, '|') AS items FROM (SELECT p_partkey, CASE WHEN source_var = lower(family) THEN [source_var] ELSE [source_var, lower(family)] END AS list_distinct_in_order FROM registry)")
def p22(spark, d):
    text = F.concat_ws(", ", "source_var", F.lower("family"), F.concat(F.lit(" "), "source_var"))
    return registry(spark, d).select("p_partkey", F.array_join(names.list_items(text), "|").alias("items"))


@query("a17_count_by_group", f"WITH {REGISTRY} SELECT family, count(target_var) AS n FROM registry GROUP BY family")
def a17(spark, d):
    return registry(spark, d).groupBy("family").agg(F.count("target_var").alias("n"))


@query("a18_joined_sets", f"WITH {REGISTRY} SELECT level, string_agg(DISTINCT family, ', ' ORDER BY family) AS families FROM registry GROUP BY level")
def a18(spark, d):
    return registry(spark, d).groupBy("level").agg(F.array_join(F.array_sort(F.collect_set("family")), ", ").alias("families"))


@query("a19_consistent_attributes", f"WITH {REGISTRY} SELECT source_var, 'u' || source_var AS units FROM registry GROUP BY ALL")
def a19(spark, d):
    return reg.consistent(registry(spark, d).withColumn("units", F.concat(F.lit("u"), "source_var")), "source_var", "units")


@query("a20_ambiguous_keys", f"WITH {REGISTRY} SELECT target_var, family, count(DISTINCT source_var) AS n, min(source_var) AS first FROM registry GROUP BY ALL HAVING count(DISTINCT source_var) > 1")
def a20(spark, d):
    x = reg.ambiguous(registry(spark, d), "source_var", "target_var", "family")
    return x.select("target_var", "family", F.size("values").cast("long").alias("n"), F.col("values")[0].alias("first"))


@query("o03_head_sorted", f"WITH {REGISTRY} SELECT p_partkey, family, level FROM registry ORDER BY family, run_type, level, source_var, p_partkey LIMIT 20")
def o03(spark, d):
    return reg.sorted_registry(registry(spark, d), "family", "run_type", "level", "source_var", "p_partkey").limit(20).select("p_partkey", "family", "level")


@query("o08_sort_nulls_last", f"WITH {REGISTRY} SELECT p_partkey, f AS family, row_number() OVER (ORDER BY f NULLS LAST, p_partkey) AS place FROM (SELECT p_partkey, CASE WHEN size % 5 <> 0 THEN family END AS f FROM registry)")
def o08(spark, d):
    x = registry(spark, d).select("p_partkey", F.when(F.col("size") % 5 != 0, F.col("family")).alias("family"))
    return sinks.numbered(x, "family", "p_partkey")


@query("p21_catalog_filter", f"WITH {CATALOG} SELECT index, source_id FROM catalog WHERE (index BETWEEN 0 AND 5 OR index = 8) AND experiment_id = 'historical'")
def p21(spark, d):
    c = catalog(spark, d)
    spec = c.where("index = 0").select(F.explode(names.index_spec_items(F.concat(F.lit("0-5, 8,"), F.col("index").cast("string")))).alias("index"))
    return c.join(F.broadcast(spec), "index", "left_semi").where("experiment_id = 'historical'").select("index", "source_id")


@query("p13_clip_period", f"WITH {CATALOG} SELECT index, greatest(sim_start_year, 2000) AS first_year, least(sim_end_year, 2010) AS last_year FROM catalog WHERE greatest(sim_start_year, 2000) <= least(sim_end_year, 2010)")
def p13(spark, d):
    a, b = select.clip_period(F.col("sim_start_year"), F.col("sim_end_year"), F.lit(2000), F.lit(2010))
    return catalog(spark, d).select("index", a.alias("first_year"), b.alias("last_year")).where("first_year <= last_year")


MONTHS = CATALOG + ", m AS (SELECT index, unnest(generate_series(make_date(sim_start_year, 1, 1)::TIMESTAMP, make_date(sim_end_year, 12, 1)::TIMESTAMP, INTERVAL 1 MONTH)) AS m FROM catalog)"


@query("t03_time_windows", f"WITH {MONTHS} SELECT index, strftime(m, '%Y-%m-%dT00:00:00Z') AS win_start, strftime(m + INTERVAL 1 MONTH - INTERVAL 1 DAY, '%Y-%m-%dT23:00:00Z') AS win_end, strftime(m, '%Y-%m') AS label FROM m UNION ALL SELECT index, y || '-01-01T00:00:00Z', y || '-12-31T23:00:00Z', CAST(y AS VARCHAR) FROM (SELECT index, unnest(range(sim_start_year, sim_end_year + 1)) AS y FROM catalog) UNION ALL SELECT index, sim_start_year || '-01-01T00:00:00Z', sim_end_year || '-12-31T23:00:00Z', sim_start_year || '-' || sim_end_year FROM catalog UNION ALL SELECT index, sim_start_year || '-01-01T00:00:00Z', sim_start_year || '-01-01T01:00:00Z', 'static' FROM catalog")
def t03(spark, d):
    c = catalog(spark, d)
    cols = ("index", "win_start", "win_end", "label")
    out = windows.time_windows(c, "month").select(*cols)
    for mode in ("year", "full", "static"):
        out = out.union(windows.time_windows(c, mode).select(*cols))
    return out


@query("t02_month_windows", "WITH o AS (SELECT o_custkey, min(o_orderdate) AS a, max(o_orderdate) AS z FROM orders GROUP BY ALL), m AS (SELECT o_custkey, a, z, unnest(generate_series(date_trunc('month', a)::TIMESTAMP, date_trunc('month', z)::TIMESTAMP, INTERVAL 1 MONTH)) AS m FROM o) SELECT o_custkey, strftime(m, '%Y-%m') AS label, strftime(greatest(m, a), '%Y-%m-%d %H:%M:%S') AS win_start, strftime(least(m + INTERVAL 1 MONTH - INTERVAL 1 HOUR, z), '%Y-%m-%d %H:%M:%S') AS win_end FROM m")
def t02(spark, d):
    o = table(spark, d, "orders").groupBy("o_custkey").agg(F.min("o_orderdate").alias("start"), F.max("o_orderdate").alias("end"))
    return windows.month_windows(o).select("o_custkey", "label", at("win_start"), at("win_end"))


@query("t04_day_windows", "WITH o AS (SELECT user_id, min(ts) AS a, max(ts) AS z FROM events GROUP BY ALL) SELECT user_id, strftime(d, '%Y-%m-%d 00:00:00') AS day_start, strftime(d, '%Y-%m-%d 23:00:00') AS day_end FROM (SELECT user_id, unnest(generate_series(date_trunc('day', a)::TIMESTAMP, date_trunc('day', z)::TIMESTAMP, INTERVAL 1 DAY)) AS d FROM o)")
def t04(spark, d):
    o = table(spark, d, "events").groupBy("user_id").agg(F.min("ts").alias("start"), F.max("ts").alias("end"))
    return windows.day_windows(o).select("user_id", at("day_start"), at("day_end"))


@query("t15_next_month", "SELECT o_orderkey, CAST(strftime(date_trunc('month', o_orderdate) + INTERVAL 1 MONTH, '%Y%m') AS INTEGER) AS yyyymm, CAST(day(last_day(o_orderdate)) AS INTEGER) AS days FROM orders")
def t15(spark, d):
    o = table(spark, d, "orders")
    return o.select("o_orderkey", windows.next_month(F.date_format("o_orderdate", "yyyyMM")).alias("yyyymm"), windows.days_in_month(F.col("o_orderdate")).alias("days"))


@query("s20_download_plan", f"WITH {CATALOG}, y AS (SELECT *, unnest(range(sim_start_year, sim_end_year + 1)) AS y FROM catalog) SELECT index, CAST(y AS VARCHAR) AS label, 'https://example.org/' || source_id || '_' || experiment_id || '_r1i1p1_v1-r1_' || ncml_timerange || '.ncml?var=tas&var=pr&time_start=' || y || '-01-01T00%3A00%3A00Z&time_end=' || y || '-12-31T23%3A00%3A00Z' AS url, dest_subdir || '/' || source_id || '_' || experiment_id || '_r1i1p1_v1-r1_' || ncml_timerange || '_' || y || '.nc' AS path FROM y")
def s20(spark, d):
    return windows.download_plan(catalog(spark, d), "year", ["tas", "pr"], "https://example.org")


NESTED = [("power", "si10"), ("power", "rho"), ("si10", "u10"), ("si10", "v10"), ("rho", "t2m"), ("rho", "sp"), ("sp", "lnsp")]


@query(
    "p23_nested_dependencies",
    f"""WITH RECURSIVE deps(var, part) AS (VALUES {', '.join(map(str, NESTED))}),
r AS (SELECT var, part, 1 AS steps FROM deps UNION ALL SELECT r.var, d.part, r.steps + 1 FROM r JOIN deps d ON d.var = r.part),
lv AS (SELECT var, max(steps) AS level FROM r GROUP BY var),
w AS (SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN 'power' WHEN 1 THEN 'si10' ELSE 't2m' END AS var FROM orders),
x AS (SELECT o_orderkey, var FROM w UNION SELECT o_orderkey, r.part FROM w JOIN r USING (var))
SELECT o_orderkey, string_agg(x.var, ',' ORDER BY coalesce(lv.level, 0), x.var) AS need FROM x LEFT JOIN lv ON lv.var = x.var GROUP BY o_orderkey""",
)
def p23_nested(spark, d):
    """Derived of derived: each order's variable with all it needs, parts first."""
    k = F.col("o_orderkey") % 3
    wanted = table(spark, d, "orders").select("o_orderkey", F.when(k == 0, "power").when(k == 1, "si10").otherwise("t2m").alias("var"))
    x = select.needed_in_order(wanted, spark.createDataFrame(NESTED, "var string, part string"), "o_orderkey")
    return x.select("o_orderkey", F.array_join("need", ",").alias("need"))


@query("p12_process_bounds", f"WITH {CATALOG} SELECT index, sim_start_year || '-01-01 00:00:00' AS start, sim_end_year || CASE WHEN index % 2 = 0 THEN '-12-31 23:00:00' ELSE '-12-31 06:00:00' END AS stop FROM catalog")
def p12(spark, d):
    c = catalog(spark, d)
    end = F.concat(F.col("sim_end_year").cast("string"), F.when(F.col("index") % 2 == 0, "-12-31").otherwise("-12-31 06:00:00"))
    a, b = select.period_bounds(F.concat(F.col("sim_start_year").cast("string"), F.lit("-01-01")), end)
    return c.select("index", a.alias("start"), b.alias("stop")).select("index", at("start"), at("stop"))


@query("p24_single_types", f"WITH {CATALOG} SELECT source_id, min(ncml_timerange) AS ncml_timerange FROM catalog GROUP BY source_id")
def p24(spark, d):
    return select.single_types(catalog(spark, d), "ncml_timerange", "source_id")


@query("p23_dependencies", "SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN 'u10,v10,si10,lsp,cp,tp' WHEN 1 THEN 't2m,u10,v10,si10' ELSE 't2m' END AS need FROM orders")
def p23(spark, d):
    deps = {"si10": ["u10", "v10"], "tp": ["lsp", "cp"]}
    k = F.col("o_orderkey") % 3
    asked = names.list_items(F.when(k == 0, "si10, tp").when(k == 1, "t2m u10,si10").otherwise("t2m"))
    return table(spark, d, "orders").select("o_orderkey", F.array_join(select.with_dependencies(asked, deps), ",").alias("need"))


@query("s25_tiles", "WITH b AS (SELECT c_custkey, CAST(c_custkey % 300 - 150 AS BIGINT) AS west, CAST(c_custkey % 100 - 50 AS BIGINT) AS south FROM customer), t AS (SELECT c_custkey, unnest(generate_series(CAST(floor(south / 30) * 30 AS BIGINT), CAST(floor((south + 25) / 30) * 30 AS BIGINT), 30)) AS la, west FROM b), u AS (SELECT c_custkey, la, unnest(generate_series(CAST(floor(west / 30) * 30 AS BIGINT), CAST(floor((west + 35) / 30) * 30 AS BIGINT), 30)) AS lo FROM t) SELECT c_custkey, CASE WHEN la < 0 THEN 's' ELSE 'n' END || lpad(CAST(abs(la) AS VARCHAR), 2, '0') || CASE WHEN lo < 0 THEN 'w' ELSE 'e' END || lpad(CAST(abs(lo) AS VARCHAR), 3, '0') AS tile FROM u")
def s25(spark, d):
    b = table(spark, d, "customer").select("c_custkey", (F.col("c_custkey") % 300 - 150).alias("west"), (F.col("c_custkey") % 100 - 50).alias("south"))
    return windows.tiles(b.withColumns({"east": F.col("west") + 35, "north": F.col("south") + 25})).select("c_custkey", "tile")


@query("s23_layout_switch", "SELECT o_orderkey, CASE WHEN o_orderdate + INTERVAL 22 YEAR < DATE '2021-03-23' THEN 'run.' || strftime(o_orderdate + INTERVAL 22 YEAR, '%Y%m%d') || '/06/' ELSE 'run.' || strftime(o_orderdate + INTERVAL 22 YEAR, '%Y%m%d') || '/06/atmos/' END AS prefix FROM orders")
def s23(spark, d):
    o = table(spark, d, "orders")
    return o.select("o_orderkey", windows.layout_prefix(F.add_months(F.to_date("o_orderdate"), 264), F.lit(6)).alias("prefix"))


@query("w14_registry_csv", f"WITH {REGISTRY} SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, target_var, family, level, run_type, source_var FROM registry")
def w14(spark, d):
    path = sinks.scratch(spark, "registry")
    sinks.write_registry(registry(spark, d).select("p_partkey", "target_var", "family", "level", "run_type", "source_var"), path)
    return tables.registry_csv(spark, path)


@query("w16_description_text", f"WITH {REGISTRY} SELECT 'v' || p_partkey AS var, long_name AS description, family AS long_name, 'm s**-1' AS units FROM registry")
def w16(spark, d):
    path = sinks.scratch(spark, "descriptions")
    r = registry(spark, d).select(F.concat(F.lit("v"), "p_partkey").alias("var"), F.col("long_name").alias("description"), F.col("family").alias("long_name"), F.lit("m s**-1").alias("units"))
    sinks.write_descriptions(r, path)
    return tables.description_blocks(spark, path)


@query("s11_catalog_csv", f"WITH {CATALOG} SELECT * FROM catalog")
def s11(spark, d):
    path = sinks.scratch(spark, "catalog")
    sinks.write_result(catalog(spark, d), path, "csv")
    return tables.catalog_csv(spark, path)
