"""Adapter: the star-schema test tables -> a raw claim snapshot history.

One history row per line.  Lines of one part and ship day are numbered by
order key, line number, supplier, price, quantity, return flag and status;
the number is part of the claim's, so a claim has one snapshot a day.  Every
column is text, so staging's trims and safe casts run for real.  Rules (same
in the DuckDB oracle):

* claim_number ' CLM-<partkey>-<number> ' (padded), snapshot/last-seen = ship day
* status O -> Open, F -> Closed; case_date_closed = ship day when Closed
* reason A/R/N -> the three steering reasons, null for line numbers >= 6
* insurance_claims_results by line number % 3 (0, 1, 2 -> wait, not liable, null)
* results by line number (1-4 steering results, 5 'Other', 6-7 null)
* source 'Provider <orderstatus>'; carrier null when suppkey % 7 = 0 else
  'Carrier <suppkey % 3>'; country US/CA by region parity
* currency by order priority digit: USD, ' cad ', '', null, MXN
* submitted = order date, date_of_loss = order date - line number days,
  dropped_off_date 'not a date' on line 6 else order date - 30 days
* value_of_trailer = extended price as 2-decimal text; trailer plate/number/
  vin = brand / partkey / part name
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from claimtide import schemas as S
from claimtide.schemas import RAW_COLUMNS


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def testdata_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = _table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_partkey",
        "l_suppkey",
        "l_linenumber",
        "l_quantity",
        "l_extendedprice",
        "l_returnflag",
        "l_linestatus",
        F.to_date("l_shipdate").alias("ship_day"),
    )
    # a window group holds one part's lines of one day: a handful
    of_day = Window.partitionBy("l_partkey", "ship_day").orderBy(
        "l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice", "l_quantity", "l_returnflag", "l_linestatus"
    )
    line = line.withColumn("line_of_day", F.row_number().over(of_day))

    orders = _table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"),
        "o_orderstatus",
        "o_orderpriority",
        F.to_date("o_orderdate").alias("order_day"),
    )
    supplier = _table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("n_nationkey")
    )
    nation = _table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    part = _table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_brand", "p_name")

    joined = (
        line.join(orders, "l_orderkey")
        .join(supplier, "l_suppkey")
        .join(nation, "n_nationkey")
        .join(part, "l_partkey")
    )

    n = F.col("l_linenumber")
    closed = F.col("l_linestatus") == "F"
    ship_text = F.col("ship_day").cast("string")
    priority = F.substring("o_orderpriority", 1, 1)
    columns = {
        "claim_number": F.concat(
            F.lit(" CLM-"),
            F.col("l_partkey").cast("string"),
            F.lit("-"),
            F.col("line_of_day").cast("string"),
            F.lit(" "),
        ),
        "snapshot_date": ship_text,
        "carrier_name": F.when(
            F.col("l_suppkey") % 7 != 0, F.concat(F.lit("Carrier "), (F.col("l_suppkey") % 3).cast("string"))
        ),
        "country": F.when(F.col("n_regionkey") % 2 == 0, F.lit("US")).otherwise(F.lit("CA")),
        "status": F.when(F.col("l_linestatus") == "O", F.lit(S.STATUS_OPEN)).when(closed, F.lit(S.STATUS_CLOSED)),
        "reason": F.when(n >= 6, F.lit(None))
        .when(F.col("l_returnflag") == "A", F.lit(S.REASON_FOUND))
        .when(F.col("l_returnflag") == "R", F.lit(S.REASON_NO_DATA))
        .when(F.col("l_returnflag") == "N", F.lit(S.REASON_NOT_IN_NETWORK)),
        "results": F.when(n == 1, F.lit(S.RESULT_CARRIER_PICKED_UP))
        .when(n == 2, F.lit(S.RESULT_TOWING_YARD))
        .when(n == 3, F.lit(S.RESULT_RECOVERED))
        .when(n == 4, F.lit(S.RESULT_NO_RESPONSE))
        .when(n == 5, F.lit("Other")),
        "insurance_claims_results": F.when(n % 3 == 0, F.lit(S.ICR_WAITING)).when(
            n % 3 == 1, F.lit(S.ICR_NOT_LIABLE)
        ),
        "source": F.concat(F.lit("Provider "), F.col("o_orderstatus")),
        "trailer_license_plate": F.col("p_brand"),
        "trailer_number": F.col("l_partkey").cast("string"),
        "trailer_vin": F.col("p_name"),
        "currency": F.when(priority == "1", F.lit("USD"))
        .when(priority == "2", F.lit(" cad "))
        .when(priority == "3", F.lit(""))
        .when(priority == "5", F.lit("MXN")),
        "submitted": F.col("order_day").cast("string"),
        "date_of_loss": F.date_sub("order_day", n).cast("string"),
        "dropped_off_date": F.when(n == 6, F.lit("not a date")).otherwise(
            F.date_sub("order_day", 30).cast("string")
        ),
        "case_date_closed": F.when(closed, ship_text),
        "last_seen_date": ship_text,
        "value_of_trailer": F.col("l_extendedprice").cast("decimal(18,2)").cast("string"),
    }
    return joined.select(*(columns[c].cast("string").alias(c) for c in RAW_COLUMNS))
