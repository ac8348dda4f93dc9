from datetime import datetime

from pyspark.sql import functions as F

from deskwise.plans import staging
from deskwise.settings import Settings
from deskwise.sources import schemas

AS_OF = datetime(2026, 2, 1)
SETTINGS = Settings(as_of=AS_OF)
SEED = [("HEAT/HOT WATER", "Housing & Buildings", "Heat & Hot Water", True)]


def ts(text):
    return None if text is None else datetime.fromisoformat(text)


def raw_requests(spark, rows):
    """Landed requests from partial dicts; times may be given as text."""
    full = [{n: r.get(n) for n in [*schemas.REQUEST_FIELDS, schemas.LOAD_ID]} for r in rows]
    ddl = ", ".join(f"{n} string" for n in [*schemas.REQUEST_FIELDS, schemas.LOAD_ID])
    landed = spark.createDataFrame([tuple(r.values()) for r in full], ddl)
    stamps = ("created_date", "closed_date", "resolution_action_updated_date")
    return landed.withColumns({c: F.col(c).cast("timestamp_ntz") for c in stamps})


def request(key, created, closed=None, updated=None, **other):
    return {
        "unique_key": key,
        "created_date": created,
        "closed_date": closed,
        "resolution_action_updated_date": updated if updated is not None else closed,
        "status": "Open" if closed is None else "Closed",
        "agency": "HPD",
        "complaint_type": "X",
        "borough": "BRONX",
        **other,
    }


def staged(spark, rows):
    return staging.stg_requests(raw_requests(spark, rows))


def seed(spark, rows=SEED):
    return spark.createDataFrame(rows, schemas.SEED)


def rows_of(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
