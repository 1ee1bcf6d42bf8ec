"""An append-only log in a folder that a crash cannot damage.

Every write goes to a new folder ``data/<unique>``; a small file ``commits/<number>``, written last and never
overwritten, makes it part of the log.  A writer that dies before its commit leaves a folder that no commit names; one that
is run again with the same ``txn`` finds its own commit and writes nothing.  Two writers cannot take one number: creating
the file fails for the second, which takes the next.  The input of a write is never its output.

Rows are dealt to ``buckets`` by the hash of ``key``.  A point update rewrites the rows of one bucket: its commit says that
older rows of that bucket no longer count.  Readers skip the replaced buckets by folder (partition pruning).

A JSON array file can be the base of a log: its entries are older than all commits, and it is only read.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plinth.operators.features import col

_COMMIT, _BUCKET = "_commit", "_bucket"


class CommitLog:
    """A log at ``path``; ``fmt`` is json or parquet, ``base`` an array file that it continues (then with one bucket)."""

    def __init__(self, spark: SparkSession, path: str, key: str | None = None, buckets: int = 16, fmt: str = "parquet",
                 base: str | None = None, base_schema: T.StructType | str | None = None):
        if base is not None and key is not None:
            raise ValueError("an array file cannot be updated by bucket")
        self.spark, self.path, self.key, self.fmt, self.base = spark, path.rstrip("/"), key, fmt, base
        self.buckets = buckets if key else 1
        self.base_schema = T._parse_datatype_string(base_schema) if isinstance(base_schema, str) else base_schema

    def _store(self, at: str):
        """(file system of the log's store, path in it)."""
        p = self.spark._jvm.org.apache.hadoop.fs.Path(at)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def commits(self) -> list[dict]:
        """The commits in order: number, folder, replaced bucket (or None), txn, schema."""
        store, p = self._store(f"{self.path}/commits")
        if not store.exists(p):
            return []
        out = []
        for f in store.listStatus(p):
            if f.getPath().getName().isdigit():
                stream = store.open(f.getPath())
                text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
                stream.close()
                if text.endswith("}\n"):  # else its writer died in the middle; the number stays unused
                    out.append(json.loads(text) | {"number": int(f.getPath().getName())})
        return sorted(out, key=lambda c: c["number"])

    def _commit(self, after: int, entry: dict, conflict: Callable[[int], bool]) -> int:
        """Take the next free number; ``conflict(after)`` tells whether later commits make the entry wrong."""
        number = after + 1
        while True:
            store, p = self._store(f"{self.path}/commits/{number:020d}")
            try:
                out = store.create(p, False)
            except Exception as e:  # taken by another writer
                if not store.exists(p):
                    raise
                if conflict(after):
                    raise RuntimeError("the bucket was written meanwhile; run the update again") from e
                number += 1
                continue
            out.write(bytearray((json.dumps(entry) + "\n").encode()))
            out.close()
            return number

    def _write(self, rows: DataFrame) -> dict:
        folder = f"data/{uuid.uuid4().hex}"
        bucket = F.pmod(F.xxhash64(col(self.key)), F.lit(self.buckets)).cast("int") if self.key else F.lit(0)
        rows.withColumn(_BUCKET, bucket).write.partitionBy(_BUCKET).format(self.fmt).save(f"{self.path}/{folder}")
        return {"folder": folder, "schema": json.loads(rows.schema.json())}

    def _done(self, txn: str | None) -> int | None:
        return next((c["number"] for c in self.commits() if txn is not None and c.get("txn") == txn), None)

    def append(self, rows: DataFrame, txn: str | None = None) -> int:
        """Add rows; new columns join the log's schema.  Returns the commit's number, also of an earlier run of ``txn``."""
        done = self._done(txn)
        if done is not None:
            return done
        entry = self._write(rows) | {"replaces": None, "txn": txn}
        return self._commit(max([0, *(c["number"] for c in self.commits())]), entry, lambda _: False)

    def _schema(self, commits: list[dict]) -> T.StructType:
        fields: dict[str, T.StructField] = {f.name: f for f in (self.base_schema or T.StructType()).fields}
        for c in commits:
            for f in T.StructType.fromJson(c["schema"]).fields:
                fields.setdefault(f.name, T.StructField(f.name, f.dataType, True))
        return T.StructType(list(fields.values()))

    def _rows(self, commits: list[dict], where: Column | None = None) -> DataFrame:
        schema = self._schema(commits)
        if commits:
            full = T.StructType([*schema.fields, T.StructField(_BUCKET, T.IntegerType())])
            parts, since = [], {c["replaces"]: c["number"] for c in commits if c["replaces"] is not None}
            for c in commits:
                old = [b for b, n in since.items() if n > c["number"]]
                got = self.spark.read.schema(full).format(self.fmt).load(f"{self.path}/{c['folder']}")
                got = got.where(~F.col(_BUCKET).isin(old)) if old else got
                parts.append((got if where is None else got.where(where)).withColumn(_COMMIT, F.lit(c["number"])))
            out = parts[0]
            for p in parts[1:]:
                out = out.unionByName(p)
        else:
            out = self.spark.createDataFrame([], T.StructType([*schema.fields, T.StructField(_BUCKET, T.IntegerType()), T.StructField(_COMMIT, T.IntegerType())]))
        if self.base is not None:
            first = self.spark.read.schema(schema).option("multiLine", True).option("recursiveFileLookup", True).json(self.base)
            out = first.withColumns({_BUCKET: F.lit(0), _COMMIT: F.lit(0)}).unionByName(out)
        return out

    def read(self, with_commit: bool = False) -> DataFrame:
        """All rows that count, in the columns of the log; ``with_commit`` adds the number of each row's commit."""
        out = self._rows(self.commits()).drop(_BUCKET)
        return out if with_commit else out.drop(_COMMIT)

    def latest(self, key: str) -> DataFrame:
        """Of every key the row of the newest commit (a manifest)."""
        rows = self.read(with_commit=True)
        names = [c for c in rows.columns if c not in (key, _COMMIT)]
        return rows.groupBy(col(key)).agg(F.max_by(F.struct(*[col(c) for c in names]), _COMMIT).alias("_r")).select(col(key), "_r.*")

    def update(self, value, change: Callable[[DataFrame], DataFrame], txn: str | None = None) -> int:
        """``change`` the rows of the bucket of key ``value``: only that bucket is read and rewritten."""
        done = self._done(txn)
        if done is not None:
            return done
        commits = self.commits()
        kind = self._schema(commits)[self.key].dataType
        bucket = self.spark.range(1).select(F.pmod(F.xxhash64(F.lit(value).cast(kind)), F.lit(self.buckets)).cast("int")).first()[0]
        rows = change(self._rows(commits, F.col(_BUCKET) == bucket).drop(_BUCKET, _COMMIT))
        number = max([0, *(c["number"] for c in commits)])

        def touched(after: int) -> bool:
            return any(c["number"] > after for c in self.commits())

        return self._commit(number, self._write(rows) | {"replaces": bucket, "txn": txn}, touched)
