"""Quality report: five checks per layer, their summary and the gate."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.operators.layers import Layer, union_all
from stratalake.operators.validity import with_validity


def _names(values: list[str]) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


def qa_layer(layer: Layer, project_epsg: int, min_rows: int = 1, max_rows: int | None = None,
             required: list[str] | None = None) -> DataFrame:
    """Rows ``layer, position, check, passed, message`` in fixed order, from one aggregate."""
    stats = with_validity(layer).agg(
        F.count(F.lit(1)).alias("n"), F.count("geometry").alias("present"),
        F.avg(F.col("valid").cast("double")).alias("rate"))
    n, rate = F.col("n"), F.col("rate")
    missing = [f for f in (required or []) if f not in layer.df.columns]
    low, high = n < min_rows, (n > max_rows) if max_rows is not None else F.lit(False)
    count = F.concat(F.lit("row count "), n.cast("string"))
    percent = F.format_string("%.1f%%", rate * 100)
    crs_ok = layer.epsg is not None and layer.epsg == project_epsg
    if layer.epsg is None:
        crs_text = "layer has no CRS set"
    elif crs_ok:
        crs_text = f"CRS matches project CRS (EPSG:{project_epsg})"
    else:
        crs_text = f"CRS is EPSG:{layer.epsg}, expected EPSG:{project_epsg}"
    # The names of the checks and the texts of the report.
    checks = [
        ("row_count", ~(low | high),
         F.when(low, F.concat(count, F.lit(f" is below minimum {min_rows}")))
          .when(high, F.concat(count, F.lit(f" exceeds maximum {max_rows}")))
          .otherwise(F.concat(count, F.lit(" is within expected range")))),
        ("required_fields", F.lit(not missing),
         F.lit(f"missing required fields: {_names(missing)}" if missing else "all required fields present")),
        ("geometry_validity", (n == 0) | (rate >= 1.0),
         F.when(n == 0, "empty layer, skipped")
          .when(rate < 1.0, F.concat(percent, F.lit(" of geometries are valid (expected 100%)")))
          .otherwise("all geometries valid")),
        ("geometry_not_null", (n == 0) | (F.col("present") > 0),
         F.when(n == 0, "empty layer, skipped")
          .when(F.col("present") == 0, "every geometry in this layer is null")
          .otherwise("geometry column has values")),
        ("crs_match", F.lit(crs_ok), F.lit(crs_text)),
    ]
    rows = F.array(*[F.struct(F.lit(layer.name).alias("layer"), F.lit(k).alias("position"), F.lit(c).alias("check"),
                              passed.alias("passed"), text.alias("message"))
                     for k, (c, passed, text) in enumerate(checks)])
    return stats.select(F.inline(rows))


def qa_report(layers: dict[str, Layer], project_epsg: int, **limits) -> DataFrame:
    """One row per layer and check, layers in order."""
    reports = [qa_layer(replace(layer, name=name), project_epsg, **limits).withColumn("_l", F.lit(k))
               for k, (name, layer) in enumerate(layers.items())]
    return union_all(reports).orderBy("_l", "position").select("layer", "check", "passed", "message")


def qa_summary(report: DataFrame) -> DataFrame:
    return report.agg(F.count_if("passed").alias("n_passed"), F.count(F.lit(1)).alias("n_total"))


def qa_gate(report: DataFrame, halt_on_failure: bool = True) -> list:
    """Failed checks; raises with all of them when ``halt_on_failure``.  The report has five rows per
    layer, so collecting the failures is bounded by the number of layers."""
    failures = report.filter("not passed").collect()
    if failures and halt_on_failure:
        raise ValueError("failed checks: " + "; ".join(f"{f['check']} of {f['layer']} ({f['message']})" for f in failures))
    return failures
