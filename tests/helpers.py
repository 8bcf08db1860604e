import datetime as dt

from pyspark.sql import types as T

from tillguard.schemas import TRANSACTION_SCHEMA

NULLABLE_TX = T.StructType([T.StructField(f.name, f.dataType, True) for f in TRANSACTION_SCHEMA.fields])

T0 = dt.datetime(2026, 8, 13, 9, 0, 0)


def tx_rows(spark, rows):
    """rows: dicts with id, terminal, bin, amount, seconds offset, optional lat/lon/fraud_type."""
    out = []
    for r in rows:
        out.append((str(r["id"]), r.get("terminal", "TRM00001"), r.get("merchant", "MRC0001"), r.get("bin", "539983"),
                    r.get("amount", 5000.0), r.get("state", "Lagos"), "Ikeja", r.get("lat", 6.5244),
                    r.get("lon", 3.3792), T0 + dt.timedelta(seconds=r["t"]), r.get("fraud_type", "") != "",
                    r.get("fraud_type", "")))
    return spark.createDataFrame(out, NULLABLE_TX)
