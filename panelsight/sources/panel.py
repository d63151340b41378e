"""Review panel derived from the warehouse tables.

One panel row = one supplier ("employee") x ship-date quarter. The line items
are pre-aggregated per (supplier, year, quarter) before anything is joined, so
the only shuffle of the large table is the partial->final hash aggregate; the
dimension joins then run on a table ~20x smaller than ``lineitem``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from panelsight.functions.scalars import (
    clip, employee_code, kpi_score, performance_band, quarter_label,
    quarter_start, rnd, tenure_offset_date,
)
from panelsight.operators.joins import sized_broadcast
from panelsight.schema import EDUCATION_LEVELS, PANEL_COLS

LINEITEM_COLS = ["l_suppkey", "l_shipdate", "l_quantity", "l_tax", "l_discount",
                 "l_returnflag", "l_linestatus"]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def supplier_quarters(lineitem: DataFrame) -> DataFrame:
    """Partial aggregate of line items per (supplier, year, quarter)."""
    li = lineitem.select(*LINEITEM_COLS).where(F.col("l_suppkey").isNotNull()
                                               & F.col("l_shipdate").isNotNull())
    return (li.groupBy(
                F.col("l_suppkey").alias("sk"),
                F.year("l_shipdate").cast("int").alias("review_year"),
                F.quarter("l_shipdate").cast("int").alias("review_quarter"))
            .agg(F.count(F.lit(1)).alias("n"),
                 F.sum("l_quantity").cast("bigint").alias("qty"),
                 F.count_if(F.col("l_returnflag") == "R").alias("r"),
                 F.count_if(F.col("l_linestatus") == "F").alias("f"),
                 F.sum(_cents("l_tax")).alias("tx"),
                 F.sum(_cents("l_discount")).alias("ds")))


def _cents(c: str):
    """Rate -> whole hundredths, half-up on the binary value (no per-row
    BigDecimal as ``round`` on doubles would use)."""
    return F.floor(F.col(c) * 100 + 0.5).cast("int")


def employee_dim(supplier: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    """Static attributes per supplier (J3 lookups, P6/P7)."""
    geo = (nation.select("n_nationkey", "n_name", "n_regionkey")
           .join(region.select("r_regionkey", "r_name"),
                 F.col("n_regionkey") == F.col("r_regionkey")))
    # one row per nation: broadcast after a size check, so that suppliers are
    # never hash-partitioned on a key with a couple of dozen values
    geo = sized_broadcast(geo)
    sk = F.col("s_suppkey")
    edu = F.element_at(F.array(*[F.lit(e) for e in EDUCATION_LEVELS]),
                       (F.pmod(sk, F.lit(len(EDUCATION_LEVELS))) + 1).cast("int"))
    return (supplier.select("s_suppkey", "s_nationkey", "s_acctbal")
            .join(geo, F.col("s_nationkey") == F.col("n_nationkey"))
            .select(
                sk.alias("sk"),
                employee_code(sk).alias("employee_id"),
                F.col("r_name").alias("department"),
                edu.alias("education"),
                F.col("n_name").alias("role"),
                (22 + F.pmod(sk, F.lit(36))).cast("int").alias("age"),
                clip(F.pmod(sk, F.lit(36)) + F.pmod(sk, F.lit(6)) - 2, 0, 35)
                .cast("int").alias("experience_years"),
                F.floor(30000 + 10 * F.greatest(F.col("s_acctbal"), F.lit(0.0)))
                .cast("int").alias("salary"),
                tenure_offset_date("1995-01-01", F.pmod(sk, F.lit(36))).alias("join_date"),
            ))


def build_panel(lineitem: DataFrame, supplier: DataFrame, nation: DataFrame,
                region: DataFrame, with_defects: bool = False) -> DataFrame:
    """The review panel of the warehouse tables.

    ``with_defects`` plants the defects that the cleaning operators are checked
    on: about 0.5 % repeated rows and 3 % blanks in four measures.
    """
    agg = supplier_quarters(lineitem)
    dim = employee_dim(supplier, nation, region)
    n = F.col("n").cast("double")
    t = F.col("review_year") * 4 + F.col("review_quarter")
    h = F.pmod(31 * F.col("sk") + t, F.lit(33))

    base = agg.join(dim, "sk").select(
        "sk", "employee_id", "department", "education", "role", "age",
        "experience_years", "salary", "join_date", "review_year", "review_quarter",
        quarter_label("review_year", "review_quarter").alias("quarter_label"),
        quarter_start("review_year", "review_quarter").alias("review_date"),
        rnd(F.col("qty").cast("double") / n - 10, 1).alias("training_hours"),
        rnd(1 - 0.4 * F.col("r") / n, 3).alias("attendance_rate"),
        rnd(6 * F.col("tx") / n, 1).alias("overtime_hours"),
        F.floor(n / 5).cast("int").alias("projects_completed"),
        rnd(clip(3 + 8 * (F.col("f") / n - 0.5), 1.0, 5.0), 2).alias("manager_rating"),
        rnd(clip(0.6 * F.col("ds") / n, 1.0, 5.0), 2).alias("peer_score"),
        rnd(clip(F.col("qty").cast("double") / 7, 10.0, 100.0), 1).alias("goal_achievement_pct"),
        h.alias("_h"), t.alias("_t"),
    )
    score = kpi_score("goal_achievement_pct", "manager_rating", "peer_score",
                      "attendance_rate", "training_hours", "projects_completed",
                      "overtime_hours")
    panel = base.withColumn("performance_score", score).withColumn("performance_band", performance_band("performance_score"))
    return (planted_defects(panel) if with_defects else panel).select(*PANEL_COLS)


def planted_defects(panel: DataFrame) -> DataFrame:
    """A panel before its last projection with blanks and repeated rows, by a rule over supplier and quarter."""
    nul = F.lit(None).cast("double")
    panel = (panel
             .withColumn("training_hours", F.when(F.col("_h") == 0, nul).otherwise(F.col("training_hours")))
             .withColumn("overtime_hours", F.when(F.col("_h") == 11, nul).otherwise(F.col("overtime_hours")))
             .withColumn("peer_score", F.when(F.col("_h") == 17, nul).otherwise(F.col("peer_score")))
             .withColumn("goal_achievement_pct", F.when(F.col("_h") == 23, nul).otherwise(F.col("goal_achievement_pct"))))
    # Repeated rows (identical copies) are generated in place -- a
    # narrow Generate, not a union with a second scan of the line items
    copies = F.when(F.pmod(7 * F.col("sk") + F.col("_t"), F.lit(200)) == 0, 2).otherwise(1)
    return panel.withColumn("_copy", F.explode(F.sequence(F.lit(1), copies)))


def load_panel(spark: SparkSession, sf_dir: str, with_defects: bool = False) -> DataFrame:
    """Panel view over ``sf_dir``."""
    return build_panel(read_table(spark, sf_dir, "lineitem"),
                       read_table(spark, sf_dir, "supplier"),
                       read_table(spark, sf_dir, "nation"),
                       read_table(spark, sf_dir, "region"),
                       with_defects=with_defects)


def densify_panel(panel: DataFrame, employees: DataFrame) -> DataFrame:
    """Every employee of the panel x every quarter from the panel's first to its last.

    The attributes come from the employee dimension, the measures from the
    panel; quarters without a review have NULL measures. The calendar is
    generated on each employee's row, then facts are joined on the panel key.
    """
    emp_cols = ["employee_id", "department", "education", "role", "age",
                "experience_years", "salary", "join_date"]
    quarter = F.col("review_year") * 4 + F.col("review_quarter") - 1
    span = panel.agg(F.min(quarter).alias("lo"), F.max(quarter).alias("hi")).first()
    emps = employees.select(*emp_cols).join(panel.select("employee_id").distinct(), "employee_id", "left_semi")
    if span.lo is None:
        emps, span = emps.limit(0), Row(lo=0, hi=0)
    t = F.explode(F.sequence(F.lit(span.lo), F.lit(span.hi))).alias("_t")
    grid = (emps.select(*emp_cols, t)
            .withColumn("review_year", F.floor(F.col("_t") / 4).cast("int"))
            .withColumn("review_quarter", (F.pmod(F.col("_t"), F.lit(4)) + 1).cast("int"))
            .withColumn("quarter_label", quarter_label("review_year", "review_quarter"))
            .withColumn("review_date", quarter_start("review_year", "review_quarter"))
            .drop("_t"))
    measures = [c for c in PANEL_COLS if c not in emp_cols + ["quarter_label", "review_date"]]
    facts = panel.select("employee_id", *measures).dropDuplicates(["employee_id", "review_year", "review_quarter"])
    return grid.join(facts, ["employee_id", "review_year", "review_quarter"], "left").select(*PANEL_COLS)
