"""Variable registries: loading, checks, lookups and building."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.names import TARGET, clean_text, dimensions, first_known, modes, normal_level, offered, truthy

KEY = ("target_var", "family", "level", "run_type")


def require_columns(df: DataFrame, *names: str) -> DataFrame:
    if missing := [n for n in names if n not in df.columns]:
        raise ValueError(f"Columns missing: {missing}")
    return df


def trimmed(df: DataFrame) -> DataFrame:
    return df.select(*(F.trim(c).alias(c) if t == "string" else F.col(c) for c, t in df.dtypes))


def load(df: DataFrame, key: tuple[str, ...] = KEY, flag: str | None = "include_in_cli") -> DataFrame:
    """A registry with trimmed texts and its flag as a boolean; missing columns, blank keys and repeated keys are errors."""
    x = trimmed(require_columns(df, *key))
    blank = x.where(" or ".join(f"coalesce({k}, '') = ''" for k in key))
    if not blank.isEmpty():
        raise ValueError(f"Blank key: {blank.first()}")
    if (again := repeated_keys(x, *key).first()) is not None:
        raise ValueError(f"Repeated key: {again}")
    return x.withColumn(flag, truthy(F.col(flag))) if flag and flag in x.columns else x


def without_blanks(df: DataFrame, *names: str) -> DataFrame:
    """Rows where none of the columns is blank; blank texts elsewhere become null."""
    x = trimmed(df).select(*(F.nullif(F.col(c), F.lit("")).alias(c) if t == "string" else F.col(c) for c, t in df.dtypes))
    return x.dropna(subset=[*names])


def repeated_keys(df: DataFrame, *key: str) -> DataFrame:
    return df.groupBy(*key).agg(F.count("*").alias("n")).where("n > 1")


def ambiguous(df: DataFrame, value: str, *key: str) -> DataFrame:
    """Keys with several values: (key, values)."""
    return df.groupBy(*key).agg(F.array_sort(F.collect_set(value)).alias("values")).where(F.size("values") > 1)


def unresolved(specs: DataFrame, registry: DataFrame, key: tuple[str, ...] = KEY) -> DataFrame:
    return specs.join(registry, [*key], "left_anti")


def resolve(specs: DataFrame, registry: DataFrame, key: tuple[str, ...] = KEY) -> DataFrame:
    """Specs with their registry rows; a spec without one is an error."""
    if (lost := unresolved(specs, registry, key).first()) is not None:
        raise ValueError(f"No registry row for {lost}")
    return specs.join(registry, [*key])


def group_lookup(requests: DataFrame, registry: DataFrame, alias: dict[str, str] | None = None) -> DataFrame:
    """(var_name, grp, source_var, n): registry rows of the request's group or of any ('', any, all); n distinct sources."""
    alias = {"sf": "sl"} if alias is None else alias

    def known(c: str) -> Column:
        out = F.lower(F.trim(F.coalesce(c, F.lit(""))))
        for a, b in alias.items():
            out = F.when(out == a, b).otherwise(out)
        return out

    r = registry.select("var_name", known("grp").alias("_g"), "source_var")
    q = requests.select("var_name", known("grp").alias("grp"))
    hit = q.join(r, "var_name").where(F.col("_g").isin("", "any", "all") | (F.col("_g") == F.col("grp")))
    return hit.groupBy("var_name", "grp").agg(F.max("source_var").alias("source_var"), F.count_distinct("source_var").alias("n"))


def require_unambiguous(lookup: DataFrame) -> DataFrame:
    if (two := lookup.where("n > 1").first()) is not None:
        raise ValueError(f"Ambiguous registry rows: {two}")
    return lookup.drop("n")


def source_name(explicit: Column, mapped: Column, fallback: Column, own: Column) -> Column:
    """The first that is there and not blank."""
    return F.coalesce(*(F.nullif(F.trim(c), F.lit("")) for c in (explicit, mapped, fallback)), own)


DOCUMENTED = ("documented_long_name", "documented_units", "first_version_available", "documentation_notes")


def documented(docs: DataFrame, registry: DataFrame) -> DataFrame:
    """Documentation rows, one a run type, with how many registry rows match them and what these say.

    docs: doc_id, documented_level, source_var, analysis_or_forecast, and where they are there documented_long_name,
    documented_units, first_version_available and documentation_notes, which stay as cleaned text (else empty);
    registry: level, source_var, run_type, family, long_name.
    """
    r = registry.select(
        normal_level(F.col("level")).alias("normalized_level"), clean_text(F.col("source_var")).alias("source_var"), F.lower(clean_text(F.col("run_type"))).alias("run_type"),
        clean_text(F.col("family")).alias("family"), clean_text(F.col("level")).alias("level"), clean_text(F.col("long_name")).alias("long_name"),
    )
    join_set = lambda c, sep: F.array_join(F.array_sort(F.filter(F.collect_set(c), lambda x: x != "")), sep)
    r = r.groupBy("normalized_level", "source_var", "run_type").agg(
        F.count("*").alias("n"), join_set("family", ",").alias("matched_families"), join_set("level", ",").alias("matched_registry_levels"), join_set("long_name", " | ").alias("matched_registry_long_names")
    )
    level = clean_text(F.col("documented_level"))
    d = docs.select(
        clean_text(F.col("doc_id").cast("string")).alias("doc_id"), level.alias("documented_level"), normal_level(F.col("documented_level")).alias("normalized_level"),
        clean_text(F.col("source_var")).alias("source_var"), F.lower(clean_text(F.col("analysis_or_forecast"))).alias("analysis_or_forecast"), F.explode(modes(F.col("analysis_or_forecast"))).alias("run_type"),
        *((clean_text(F.col(c)) if c in docs.columns else F.lit("")).alias(c) for c in DOCUMENTED),
    )
    out = d.join(r, ["normalized_level", "source_var", "run_type"], "left")
    text = lambda c: F.coalesce(c, F.lit("")).alias(c)
    return out.select(
        "doc_id", "documented_long_name", "documented_level", "normalized_level", (F.col("documented_level") != F.col("normalized_level")).cast("int").alias("level_alias_applied"), "source_var", "documented_units", "first_version_available", "analysis_or_forecast", "run_type", "documentation_notes",
        F.coalesce("n", F.lit(0)).alias("matched_source_registry_rows"), text("matched_families"), text("matched_registry_levels"), text("matched_registry_long_names"),
    )


def discover(listing: DataFrame) -> DataFrame:
    """Registry rows, all text, of an archive's arrays: root, family, level, source_var, run_type, attrs (JSON), shape, chunks, dtype.

    Of attributes that can have several names, the first that isn't blank counts. attrs_json: the attributes whose names
    don't begin with an underscore, by name. Arrays whose attributes can't be read give a row of blanks that isn't offered
    and says so in its notes. Attributes are read once a row, into a map in a projection of its own.
    """
    listing = listing.withColumns({"_known": F.from_json("attrs", "map<string,string>"), "_bad": F.try_parse_json("attrs").isNull()})
    attr = lambda *keys: F.coalesce(first_known(F.col("_known"), *keys), F.lit(""))
    target = F.coalesce(first_known(F.col("_known"), *TARGET), F.col("source_var"))
    group = F.concat_ws("/", "root", "level", "source_var")
    known = F.map_filter("_known", lambda k, _: ~F.startswith(k, F.lit("_")))
    read = {
        "target_var": target, "long_name": attr("long_name", "GRIB_name"), "units": attr("units", "GRIB_units"),
        "include_in_cli": offered(target, F.col("source_var"), attr("long_name", "GRIB_name")).cast("string"),
        "short_name": attr("GRIB_shortName", "short_name"), "cf_var_name": attr("GRIB_cfVarName", "cfVarName", "cf_var_name"), "standard_name": attr("standard_name", "GRIB_cfName"),
        "coordinates": attr("coordinates"), "dims": F.array_join(dimensions(F.size("shape"), F.col("run_type"), known=F.col("_known")), ","),
        "shape": F.to_json("shape"), "chunks": F.to_json("chunks"), "dtype": F.col("dtype"), "ndim": F.size("shape").cast("string"),
        "attrs_json": F.to_json(F.map_from_entries(F.array_sort(F.map_entries(known)))),
    }
    bad = F.col("_bad")
    of = lambda c: F.when(bad, "0" if c == "include_in_cli" else "").otherwise(read[c]).alias(c)
    return listing.select(
        of("target_var"), of("long_name"), of("units"), "family", "level", "source_var", F.col("run_type").alias("mode"), of("include_in_cli"),
        F.when(bad, "Failed to read attributes").otherwise("").alias("notes"), "run_type", F.col("source_var").alias("variable"),
        *map(of, ("short_name", "cf_var_name", "standard_name", "coordinates", "dims", "shape", "chunks", "dtype", "ndim")),
        group.alias("group_path"), F.concat_ws("/", group, "level").alias("array_group"), F.concat_ws("/", group, "level", "source_var").alias("array_path"), of("attrs_json"),
    )


def consistent(df: DataFrame, key: str, *attrs: str) -> DataFrame:
    """(key, attrs): what the key's rows agree on; rows that disagree are an error."""
    x = df.groupBy(key).agg(*(F.array_sort(F.collect_set(a)).alias(a) for a in attrs))
    wrong = lambda a: F.raise_error(F.concat(F.lit(f"Different {a} of "), F.col(key).cast("string"))).cast("string")
    return x.select(key, *(F.when(F.size(a) > 1, wrong(a)).otherwise(F.col(a)[0]).alias(a) for a in attrs))


def sorted_registry(df: DataFrame, *keys: str) -> DataFrame:
    return df.orderBy(*(F.col(k).asc_nulls_last() for k in (keys or ("family", "run_type", "level", "source_var"))))


def first_data_name(names: Column, *coordinates: str) -> Column:
    """The first name that is no coordinate; null without one."""
    return F.try_element_at(F.filter(names, lambda x: ~x.isin(*coordinates)), F.lit(1))
