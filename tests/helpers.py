"""Small builders for edge rows."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from milepost.schemas import LANDED


def landed(spark, entity, rows, position=True):
    """Rows of an entity as text columns; ``_position`` numbers them from 1."""
    names = LANDED[entity].fieldNames()
    data = []
    for i, row in enumerate(rows, start=1):
        unknown = set(row) - set(names)
        assert not unknown, unknown
        data.append(tuple(None if row.get(n) is None else str(row[n]) for n in names) + (i,))
    schema = T.StructType(LANDED[entity].fields + [T.StructField("position", T.LongType())])
    df = spark.createDataFrame(data, schema)
    return df if position else df.drop("position")


def texts(spark, *values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, t string")


def column(df, expr, order="i"):
    return [r[0] for r in df.orderBy(order).select(expr.alias("v")).collect()]


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def fleets(spark):
    return spark.createDataFrame(
        [(101, "fleet-1", "Hub", 7, True), (102, "fleet-2", "Yard", 8, True)],
        "retailer_location_id long, internal_id string, name string, company_id long,"
        " active boolean",
    )


def drivers(spark, *ids):
    return spark.createDataFrame([(i,) for i in ids], "driver_id string")


def ntz(text):
    return F.lit(text).cast("timestamp_ntz")
