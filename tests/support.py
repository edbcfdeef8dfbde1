"""Small fixtures in the declared input schemas."""

from __future__ import annotations

from seriesloom.schemas import INSTANCES
from seriesloom.sources.tables import conform


def instances(spark, rows):
    """Instance rows from dictionaries; columns left out are NULL or empty."""
    names = {f.name for f in INSTANCES.fields}
    unknown = {k for r in rows for k in r} - names
    assert not unknown, unknown
    data = [tuple(r.get(f.name) for f in INSTANCES.fields) for r in rows]
    return conform(spark.createDataFrame(data, INSTANCES), INSTANCES)


def by(df, key):
    return {r[key]: r for r in df.collect()}


def code(value, meaning, scheme="SCT", **more):
    return {"CodeValue": value, "CodingSchemeDesignator": scheme, "CodeMeaning": meaning, **more}
