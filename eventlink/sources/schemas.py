"""Record schemas of the delimited inputs."""

from pyspark.sql import types as T

# Signalling reference, in column order; a short line leaves the tail null.
SIGNALLING_FIELDS = [
    ("id", "string"),
    ("eci", "bigint"),
    ("mme_ue_s1ap_id", "bigint"),
    ("start_ts", "bigint"),
]

GRID_FIELDS = [
    ("system", "string"),
    ("cell_x", "int"),
    ("cell_y", "int"),
    ("dlon", "double"),
    ("dlat", "double"),
]


def struct(fields: list[tuple[str, str]]) -> T.StructType:
    return T.StructType.fromDDL(", ".join(f"`{n}` {t}" for n, t in fields))
