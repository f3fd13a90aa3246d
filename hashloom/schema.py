"""Schemas of the relations, and the presets of the known collections.

Hashes are unsigned 64-bit values. Inside the engine they are BIGINT with the
same bits (see ``functions.uint64``); only at the boundary to foreign Parquet
files are they DECIMAL(20,0).
"""

from __future__ import annotations

from pyspark.sql.types import ArrayType, DataType, DoubleType, IntegerType, LongType, ShortType, StringType, StructField, StructType


def _struct(kinds: dict[str, DataType]) -> StructType:
    return StructType([StructField(name, kind) for name, kind in kinds.items()])


def _strings(names: str) -> dict[str, DataType]:
    return {name: StringType() for name in names.split()}


#: Occurrences of hashes in samples, as exported.
OCCURRENCES = StructType(
    [
        StructField("sample_id", StringType()),
        StructField("ksize", ShortType()),
        StructField("hash", LongType()),
        StructField("bucket", IntegerType()),
    ]
)


#: A table of distinct hashes from pre-deduplicated shards.
SHARD_HASHES = StructType([StructField("ksize", ShortType()), StructField("hash", LongType()), StructField("part", StringType())])

#: The event log of the work queue: each change of a file's row is one event.
QUEUE = _struct(
    {"id": LongType()}
    | _strings("subdir filename url")
    | {"size": LongType()}
    | _strings("mtime status")
    | {"tries": IntegerType()}
    | _strings("last_error out_path")
    | {"updated_at": DoubleType(), "created_at": DoubleType()}
)
STATUSES = ("PENDING", "DOWNLOADING", "SKETCHING", "DONE", "ERROR")

#: Positional fields of a bucket listing.
FILE_LIST = _struct(_strings("bucket key size modified md5 extra"))

CATALOG = _struct({"databases": ArrayType(_struct(_strings("name alias path table column set_id ksize")))})

#: K sizes, hash modulus and dedup flags of each collection.
PRESETS = {
    "AllTheBacteria": {"ksizes": (15, 31, 33), "mod": 521, "by_ksize": True, "with_counts": True},
    "GTDB": {"ksizes": (15, 31, 33), "mod": 521, "by_ksize": True, "with_counts": False},
    "SILVA": {"ksizes": (31,), "mod": 521, "by_ksize": True, "with_counts": False},
    "Serratus_viruses": {"ksizes": (15, 31, 33), "mod": 521, "by_ksize": True, "with_counts": False},
    "Logan_obelisks": {"ksizes": (15, 31, 33), "mod": 64, "by_ksize": True, "with_counts": False},
    "Logan_plasmids": {"ksizes": (15, 31, 33), "mod": 64, "by_ksize": True, "with_counts": False},
    "GenBank_TSA": {"ksizes": (15, 31, 33), "mod": 512, "by_ksize": True, "with_counts": False},
    "GenBank_TLS": {"ksizes": (15, 31, 33), "mod": 512, "by_ksize": True, "with_counts": False},
    "GenBank_genomes": {"ksizes": (15, 31, 33), "mod": 512, "by_ksize": True, "with_counts": False},
    "GenBank_WGS": {"ksizes": (31,), "mod": None, "by_ksize": True, "with_counts": False},
    "Logan_metagenomes": {"ksizes": (31,), "mod": None, "by_ksize": False, "with_counts": False},
}
