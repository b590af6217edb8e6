"""Document sources and the mapping configuration file.

Documents arrive as JSON text: one document per line in files (``read_json_documents``)
or any string column.  The mapping is configured in Java-properties text
(``key=value``, ``#`` comments, a trailing backslash continues a line).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.documents import Mapping, parse_mapping


def read_json_documents(spark: SparkSession, path: str) -> DataFrame:
    """JSON-lines files -> (doc string).  Text is kept unparsed so documents of
    any shape load; ``project_documents`` parses each one once."""
    return spark.read.text(path).select(F.col("value").alias("doc")).filter(F.length("doc") > 0)


def parse_properties(text: str) -> dict[str, str]:
    """Java-properties text -> dict (driver-side configuration only)."""
    out: dict[str, str] = {}
    pending = ""
    for raw in text.splitlines():
        line = raw.strip()
        if not pending and (not line or line.startswith(("#", "!"))):
            continue
        if line.endswith("\\"):
            pending += line[:-1]
            continue
        line, pending = pending + line, ""
        for sep in ("=", ":"):
            if sep in line:
                k, v = line.split(sep, 1)
                out[k.strip()] = v.strip()
                break
    return out


# The configuration keys of a document load.
SOURCE_COLUMNS = "esColumnList"
TARGET_COLUMNS = "hiveColumnList"
PARTITION_NAME = "hivePartitionName"
PARTITION_FORMAT = "hivePartitionFormatter"
SOURCE_PARTITION_FIELD = "es2HivePartitionName"
SOURCE_PARTITION_KIND = "es2HivePartitionFormatter"


def load_config(text: str) -> tuple[Mapping, dict[str, str]]:
    """Mapping plus partition settings from a properties file."""
    p = parse_properties(text)
    mapping = parse_mapping(p[SOURCE_COLUMNS], p[TARGET_COLUMNS], p[PARTITION_NAME])
    part = {"partition_source": p[SOURCE_PARTITION_FIELD],
            "partition_kind": p.get(SOURCE_PARTITION_KIND, "text"),
            "partition_format": p.get(PARTITION_FORMAT, "yyyy-MM-dd")}
    return mapping, part
