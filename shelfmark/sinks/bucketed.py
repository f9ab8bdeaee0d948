"""Several tables dealt into buckets by key, which change together.

Rows of a bucket lie in folders of their own; a manifest names the folders of every bucket of every table and
is written last, so that a reader sees all tables as one commit left them, and a commit that breaks changes
nothing. Commits write the buckets they touch only. Appended folders of a bucket are merged in tiers, `FAN` of
one tier into one of the next, so that a bucket has at most about FAN times log(commits) of them.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmark.session import together

FAN = 8
BUCKET = "_bucket"


@dataclass(frozen=True)
class Layout:
    """Columns of a table, the key that deals it into buckets, and how many of them there are."""

    schema: T.StructType
    keys: tuple[str, ...]
    buckets: int


@dataclass
class Change:
    """New rows of a table. `replaced` lists the buckets whose whole content they are; None appends them."""

    table: str
    rows: DataFrame
    replaced: Sequence[int] | None = None


@dataclass
class Manifest:
    """Folders by table and bucket, each with its tier, and what the commits were labelled with."""

    version: int = 0
    label: int | None = None
    layouts: dict[str, dict] = field(default_factory=dict)
    folders: dict[str, dict[str, list[list]]] = field(default_factory=dict)

    def paths(self, table: str | None = None) -> set[str]:
        tables = self.folders if table is None else {table: self.folders.get(table, {})}
        return {path for buckets in tables.values() for found in buckets.values() for path, _ in found}


class BucketedTables:
    """The tables under one folder, as the last commit left them when this object last looked (`refresh`)."""

    def __init__(self, spark: SparkSession, path: str, layouts: dict[str, Layout]) -> None:
        self.spark, self.path, self.layouts = spark, path.rstrip("/"), layouts
        self.refresh()

    def refresh(self) -> None:
        self.manifest = next((m for v in reversed(self._versions()) if (m := self._load(v)) is not None), Manifest())
        for name, layout in self.layouts.items():
            known = self.manifest.layouts.get(name)
            if known is not None and (known["buckets"], tuple(known["keys"])) != (layout.buckets, layout.keys):
                raise ValueError(f"{name} has {known['buckets']} buckets by {known['keys']}, not {layout.buckets} by {list(layout.keys)}")

    def bucket(self, table: str) -> Column:
        layout = self.layouts[table]
        return F.pmod(F.xxhash64(*layout.keys), F.lit(layout.buckets)).cast("int")

    def touched(self, table: str, rows: DataFrame) -> list[int]:
        """Buckets that the rows belong to: at most as many numbers as there are buckets."""
        return sorted(r[0] for r in rows.select(self.bucket(table)).distinct().collect())

    def read(self, table: str, buckets: Sequence[int] | None = None) -> DataFrame:
        """Rows of a table, of some buckets only where they are given."""
        layout, found = self.layouts[table], self.manifest.folders.get(table, {})
        wanted = found if buckets is None else {str(k): found.get(str(k), []) for k in buckets}
        paths = sorted(path for own in wanted.values() for path, _ in own)
        if not paths:
            return self.spark.createDataFrame([], layout.schema)
        return self.spark.read.schema(layout.schema).parquet(*[f"{self.path}/{p}" for p in paths])

    def commit(self, changes: Sequence[Change], label: int | None = None) -> None:
        """Write all changes, side by side, then switch to them at once.

        Another commit in the meantime makes this one fail, as does whatever breaks before the manifest
        is there; both leave the tables as they were.
        """
        old, version = self.manifest, max([self.manifest.version, *self._versions()]) + 1
        now = Manifest(version, label if label is not None else old.label, {n: {"buckets": x.buckets, "keys": list(x.keys)} for n, x in self.layouts.items()},
                       {name: dict(found) for name, found in old.folders.items()})
        folders = together(self.spark, *[partial(self._write, c.table, c.rows, version) for c in changes])
        for change, written in zip(changes, folders):
            own = now.folders.setdefault(change.table, {})
            if change.replaced is None:
                for k, path in written.items():
                    own[k] = [*own.get(k, []), [path, 0]]
                self._merge(change.table, own, version)
            else:
                if not set(written) <= {str(k) for k in change.replaced}:
                    raise ValueError(f"rows of {change.table} outside the buckets they replace")
                for k in map(str, change.replaced):
                    own[k] = [[written[k], 0]] if k in written else []
        self._publish(now)
        self.manifest = now
        self._expire(old)

    def _write(self, table: str, rows: DataFrame, version: int) -> dict[str, str]:
        """Folders of the rows, by bucket."""
        folder = f"{table}/commit={version}-{uuid.uuid4().hex[:8]}"
        names = [f.name for f in self.layouts[table].schema.fields]
        dealt = rows.select(*[F.col(f.name).cast(f.dataType) for f in self.layouts[table].schema.fields]).select(*names, self.bucket(table).alias(BUCKET))
        dealt.hint("rebalance", BUCKET).write.option("partitionOverwriteMode", "static").partitionBy(BUCKET).parquet(f"{self.path}/{folder}")
        return {name.split("=")[1]: f"{folder}/{name}" for name in self._list(folder) if name.startswith(f"{BUCKET}=")}

    def _merge(self, table: str, own: dict[str, list[list]], version: int) -> None:
        """Merge the folders of a tier wherever a bucket has `FAN` of them."""
        tier = 0
        while full := [k for k, found in own.items() if sum(t == tier for _, t in found) >= FAN]:
            paths = {k: [p for p, t in own[k] if t == tier] for k in full}
            rows = self.spark.read.schema(self.layouts[table].schema).parquet(*[f"{self.path}/{p}" for found in paths.values() for p in found])
            written = self._write(table, rows, version)
            for k in full:
                rest = [[p, t] for p, t in own[k] if t != tier]
                own[k] = [*rest, [written[k], tier + 1]] if k in written else rest
            tier += 1

    # --- files ---------------------------------------------------------------------------------

    def _fs(self):
        at = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        return at.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _at(self, *parts: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path("/".join((self.path, *parts)))

    def _list(self, folder: str) -> list[str]:
        fs, at = self._fs(), self._at(folder)
        return [s.getPath().getName() for s in fs.listStatus(at)] if fs.exists(at) else []

    def _versions(self) -> list[int]:
        return sorted(int(n.split(".")[0]) for n in self._list("manifest") if n.endswith(".json"))

    def _load(self, version: int) -> Manifest | None:
        """A manifest, or None for one that its writer left unfinished."""
        text = "".join(r.value for r in self.spark.read.text(f"{self.path}/manifest/{version}.json", wholetext=True).collect())
        try:
            return Manifest(**json.loads(text))
        except ValueError:
            return None

    def _publish(self, manifest: Manifest) -> None:
        """Create the manifest; fails if another writer has created this version."""
        out = self._fs().create(self._at("manifest", f"{manifest.version}.json"), False)
        try:
            out.write(bytearray(json.dumps(manifest.__dict__).encode()))
        finally:
            out.close()

    def _expire(self, before: Manifest) -> None:
        """Keep this manifest and the one before it; remove older ones and the folders that only they name."""
        kept = self.manifest.paths() | before.paths()
        for version in self._versions():
            if version < before.version:
                gone = self._load(version)
                for path in (gone.paths() if gone else set()) - kept:
                    self._fs().delete(self._at(path), True)
                self._fs().delete(self._at("manifest", f"{version}.json"), False)
        # Folders of commits that nothing names: emptied just now, or left by a commit that broke.
        for table in self.layouts:
            named = {p.split("/")[1] for p in kept if p.startswith(f"{table}/")}
            for name in self._list(table):
                if name not in named and int(name.split("=")[1].split("-")[0]) <= self.manifest.version:
                    self._fs().delete(self._at(table, name), True)
