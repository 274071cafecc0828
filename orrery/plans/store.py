"""The versioned store: immutable Parquet folders, and manifests whose exclusive creation is the commit.

A manifest lists the sets of some documents of a tenant's knowledge base, with their rows and their live folders; manifests lie
by knowledge base, so a search reads those of its own, and a small file for each set says which manifest it is in. All versions of a document share a scope and
so a manifest; publishing a version, retiring the one before it and exchanging their visibility is one commit. Whoever loses
the race reads again, checks again and tries again. Readers use the manifests they have read: files in them never change.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable
from datetime import UTC, datetime

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..errors import BuildConflict, InvalidBuild, SchemaDrift, StoreUnavailable
from ..functions import exprs as X
from ..operators import reconcile, rules, search
from ..operators.mapping import BuildData, BuildSpec
from ..sources import schemas

IMMUTABLE = "id tenant_id knowledge_base_id document_id source_uri source_name content_sha256 strategy_name profile_name profile_version config".split()
#: Folders that knowledge bases are dealt over.
AREAS = 65_536
SCOPE = ("tenant_id", "knowledge_base_id", "document_id", "strategy_name")


def _now() -> str:
    return datetime.now(UTC).isoformat()


class IndexStore:
    def __init__(self, spark: SparkSession, root: str, dimensions: int = 1536, buckets: int = 64):
        """buckets: manifests of a knowledge base; publishers of different documents disturb each other the less the more there are."""
        self.spark, self.root, self.dimensions, self.buckets = spark, root.rstrip("/"), dimensions, buckets
        self._jvm = spark.sparkContext._jvm
        self._files = self._path(self.root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    # -- manifests

    def _path(self, text: str):
        return self._jvm.org.apache.hadoop.fs.Path(text)

    @staticmethod
    def area(tenant_id: str, knowledge_base_id: str) -> str:
        """The folder of a knowledge base's manifests; several may share one."""
        return f"{X.lock_key(tenant_id, knowledge_base_id, '', '') % AREAS:05d}"

    def bucket(self, row: dict) -> str:
        return f"{self.area(row['tenant_id'], row['knowledge_base_id'])}/{X.lock_key(*(row[k] for k in SCOPE)) % self.buckets:05d}"

    def _text(self, path) -> str:
        stream = self._files.open(path)
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def _latest(self, bucket: str) -> tuple[int, dict]:
        folder = self._path(f"{self.root}/manifests/{bucket}")
        if not self._files.exists(folder):
            return 0, {}
        numbers = [int(m[1]) for s in self._files.listStatus(folder) if (m := re.fullmatch(r"(\d+)\.json", s.getPath().getName()))]
        if not numbers:
            return 0, {}
        return max(numbers), json.loads(self._text(self._path(f"{folder.toString()}/{max(numbers):012d}.json")))

    def _commit(self, bucket: str, number: int, state: dict) -> bool:
        """Creates the next manifest; False if another writer has created it."""
        folder = f"{self.root}/manifests/{bucket}"
        draft = self._path(f"{folder}/.{uuid.uuid4().hex}")
        with_content = self._files.create(draft, True)
        with_content.write(bytearray(json.dumps(state, sort_keys=True).encode()))
        with_content.close()
        target = self._path(f"{folder}/{number + 1:012d}.json")
        if self._files.getScheme() == "file":
            import os

            try:  # local renames replace their target, links don't
                os.link(draft.toUri().getPath(), target.toUri().getPath())
                return True
            except FileExistsError:
                return False
            finally:
                self._files.delete(draft, False)
        if not self._files.rename(draft, target):
            self._files.delete(draft, False)
            return False
        return True

    def _update(self, bucket: str, change: Callable[[dict], None]) -> None:
        """Applies `change` to the latest state until its commit wins; the change checks its own conditions each time."""
        for _ in range(100):
            number, state = self._latest(bucket)
            change(state)
            if self._commit(bucket, number, state):
                return
        raise StoreUnavailable("too many writers")

    def _all(self, area: str = "*") -> dict[str, dict]:
        """The rows of all sets, or of those of one area."""
        folders = self._files.globStatus(self._path(f"{self.root}/manifests/{area}/*")) or []
        names = ["/".join(f.getPath().toString().rsplit("/", 2)[1:]) for f in folders]
        return {k: v for b in sorted(names) for k, v in self._latest(b)[1].items()}

    def _place(self, set_id: str) -> str | None:
        """The manifest that a set is in, or was: the file that says so stays, and is the same whenever it is written."""
        path = self._path(f"{self.root}/places/{set_id}")
        return self._text(path) if self._files.exists(path) else None

    def _found(self, set_id: str) -> dict | None:
        place = self._place(set_id)
        return self._latest(place)[1].get(set_id) if place else None

    def _find(self, set_id: str) -> dict:
        found = self._found(set_id)
        if found is None:
            raise BuildConflict(f"there is no set {set_id}")
        return found

    # -- frames

    def _frame(self, name: str, folders: list[str | None]) -> DataFrame:
        live = [f for f in folders if f]
        schema = schemas.TABLES[name]
        return self.spark.read.schema(schema).parquet(*live) if live else self.spark.createDataFrame([], schema)

    def _write(self, name: str, set_id: str, df: DataFrame, **counted: Column) -> tuple[str, dict[str, int]]:
        """Writes a folder; what is counted is observed while its rows are written, by the same job."""
        folder = f"{self.root}/{name}/{set_id}/{uuid.uuid4().hex}"
        rows = df.select([F.col(f.name).cast(f.dataType) for f in schemas.TABLES[name].fields])
        seen = Observation()
        if counted:
            rows = rows.observe(seen, *(F.count_if(c).alias(k) for k, c in counted.items()))
        rows.write.parquet(folder)
        return folder, dict(seen.get) if counted else {}

    def frames(self, keep: Callable[[dict], bool] = lambda row: True, area: str = "*") -> tuple[DataFrame, DataFrame, DataFrame]:
        """Sets, chunks and embeddings of a snapshot, of the sets that `keep` chooses by their rows."""
        return self._frames([r for r in self._all(area).values() if keep(r)])

    def _frames(self, rows: list[dict]) -> tuple[DataFrame, DataFrame, DataFrame]:
        names = [f.name for f in schemas.SETS.fields]
        stamp = lambda v: datetime.fromisoformat(v) if v else None
        sets = self.spark.createDataFrame([tuple(stamp(r[n]) if n.endswith("_at") else r[n] for n in names) for r in rows], schemas.SETS)
        return sets, self._frame("chunks", [r["chunks"] for r in rows]), self._frame("chunk_embeddings", [r["embeddings"] for r in rows])

    # -- building

    def prepare_build(self, build: BuildData, spec: BuildSpec) -> DataFrame:
        """Stores the set (building) and its chunks; returns the inputs that have no vector of their hash yet."""
        if not re.fullmatch(X.UUID[1:-1], spec.set_id):
            raise InvalidBuild("the set's id isn't a UUID")
        rules.validate_build(build, spec.strategy_name)
        row = build.sets.first().asDict()
        bucket = self.bucket(row)
        stored = self._found(spec.set_id)
        self._same_building(stored, row)
        old_chunks = self._frame("chunks", [stored and stored["chunks"]])
        old_vectors = self._frame("chunk_embeddings", [stored and stored["embeddings"]])
        new = build.chunks.withColumn("created_at", F.lit(datetime.now(UTC)))
        kept = reconcile.upserted(old_chunks, new.select(old_chunks.columns), ["chunk_set_id", "chunk_id"], ["created_at"]).join(build.chunks.select("chunk_id"), "chunk_id", "left_semi")
        current = old_vectors.join(build.inputs.select("chunk_set_id", "chunk_id", "model_key"), ["chunk_set_id", "chunk_id", "model_key"], "left_semi")
        current = reconcile.hidden(current, build.sets)
        (chunks, _), (vectors, _) = self._write("chunks", spec.set_id, kept), self._write("chunk_embeddings", spec.set_id, current)

        def change(state: dict) -> None:
            self._same_building(state.get(spec.set_id), row)
            created = state.get(spec.set_id, {}).get("created_at") or _now()
            state[spec.set_id] = {k: row[k] for k in IMMUTABLE} | {"status": "building", "created_at": created, "activated_at": None, "chunks": chunks, "embeddings": vectors}

        if self._place(spec.set_id) != bucket:  # before the commit: a reader that finds no set there says so
            place = self._files.create(self._path(f"{self.root}/places/{spec.set_id}"), True)
            place.write(bytearray(bucket.encode()))
            place.close()
        self._update(bucket, change)
        return reconcile.missing_inputs(build.inputs, self._frame("chunk_embeddings", [vectors]))

    @staticmethod
    def _same_building(stored: dict | None, row: dict) -> None:
        if stored is not None and (stored["status"] != "building" or stored["activated_at"] or any(stored[k] != row[k] for k in IMMUTABLE)):
            raise BuildConflict(f"the set {row['id']} exists and isn't this build")

    def _building(self, row: dict | None, set_id: str) -> dict:
        if row is None or row["status"] != "building" or row["activated_at"]:
            raise BuildConflict(f"the set {set_id} isn't being built")
        return row

    def save_embeddings(self, set_id: str, records: DataFrame) -> None:
        row = self._building(self._find(set_id), set_id)
        if not rules.duplicate_inputs(records).isEmpty():
            raise InvalidBuild("R-EMB2: a record is there twice")
        now = F.lit(datetime.now(UTC))
        new = records.withColumns({"embedding": X.narrow(F.col("embedding")), "searchable": F.lit(False), "created_at": now, "updated_at": now})
        stored = self._frame("chunk_embeddings", [row["embeddings"]])
        both = reconcile.upserted(stored, new.select(stored.columns), ["chunk_set_id", "chunk_id", "model_key"], ["created_at"])
        wrong = rules.bad_record(self.dimensions) | (F.col("chunk_set_id") != set_id)
        folder, seen = self._write("chunk_embeddings", set_id, both, wrong=wrong, new=F.col("updated_at") == now)
        if seen["wrong"] or not seen["new"]:
            raise InvalidBuild("R-EMB2: the records aren't whole")

        def change(state: dict) -> None:
            if self._building(state.get(set_id), set_id)["embeddings"] != row["embeddings"]:
                raise BuildConflict(f"the set {set_id} has changed meanwhile")
            state[set_id]["embeddings"] = folder

        self._update(self.bucket(row), change)

    def validate(self, set_id: str) -> int:
        """Checks a building set as it is stored; returns the number of its vectors."""
        row = self._building(self._find(set_id), set_id)
        sets, chunks, vectors = self._frames([row])
        same = [r for r in self._all().values() if all(r[k] == row[k] for k in ("strategy_name", "profile_name", "profile_version")) and r["config"] != row["config"]]
        if same:
            raise BuildConflict("R-PUB2: the profile has another configuration elsewhere")
        rules.validate_build(BuildData(sets, chunks.withColumn("document_id", F.lit(row["document_id"])), vectors), row["strategy_name"])
        seen = vectors.agg(F.count("*").alias("n"), F.count_if(rules.bad_vector(self.dimensions)).alias("bad"), F.count_if("searchable").alias("shown")).first()
        if seen.bad or seen.shown:
            raise InvalidBuild("R-PUB3, R-PUB4: a vector is visible or isn't finite")
        return seen.n

    def publish(self, set_id: str) -> None:
        """Makes a set the active one of its scope; the active one before it retires in the same commit."""
        row = self._find(set_id)
        scope = [row[k] for k in SCOPE]
        checked = self.validate(set_id)
        switched: dict[tuple[str, bool], str] = {}

        def visible(r: dict, shown: bool) -> str:
            key = (r["embeddings"], shown)
            if key not in switched:
                rows = self._frame("chunk_embeddings", [r["embeddings"]]).withColumn("searchable", F.lit(shown))
                switched[key], seen = self._write("chunk_embeddings", r["id"], rows, shown=F.col("searchable"), bad=rules.bad_vector(self.dimensions))
                if shown and (seen["shown"] != checked or seen["bad"]):
                    raise BuildConflict(f"{seen['shown']} vectors became visible, {checked} were checked")
            return switched[key]

        def change(state: dict) -> None:
            new = self._building(state.get(set_id), set_id)
            if new["embeddings"] != row["embeddings"] or new["chunks"] != row["chunks"]:
                raise BuildConflict(f"the set {set_id} has changed since it was checked")
            active = [r for r in state.values() if r["status"] == "active" and [r[k] for k in SCOPE] == scope]
            if len(active) > 1:
                raise BuildConflict("R-PUB5: the scope has more than one active set")
            for old in active:
                old |= {"status": "retired", "embeddings": visible(old, False)}
            new |= {"status": "active", "activated_at": _now(), "embeddings": visible(new, True)}

        self._update(self.bucket(row), change)

    def delete(self, set_id: str) -> None:
        """Removes a set with its chunks and vectors from the manifest; files go once no reader needs them (`vacuum`)."""
        self._update(self.bucket(self._find(set_id)), lambda state: state.pop(set_id, None))

    def vacuum(self) -> None:
        """Deletes folders that no manifest names. Only without readers of older snapshots and running builds."""
        live = {f for r in self._all().values() for f in (r["chunks"], r["embeddings"])}
        for name in ("chunks", "chunk_embeddings"):
            for s in self._files.globStatus(self._path(f"{self.root}/{name}/*/*")) or []:
                if not any(s.getPath().toUri().getPath().endswith(f.split("://")[-1].removeprefix("file:")) for f in live):
                    self._files.delete(s.getPath(), True)

    # -- reading

    def search(self, request: search.SearchRequest) -> DataFrame:
        """Top-K over the active sets of the scope: the manifest prunes all other sets' files."""
        try:
            sets, chunks, vectors = self.frames(lambda r: r["status"] == "active" and r["tenant_id"] == request.tenant_id and r["knowledge_base_id"] == request.knowledge_base_id, self.area(request.tenant_id, request.knowledge_base_id))
            return search.search(sets, chunks, vectors, request)
        except PySparkException as cause:
            raise StoreUnavailable("the search failed") from cause

    def validate_schema(self) -> None:
        """Compares one stored folder of each table with its schema, and looks for nulls in all live rows where there may be none."""
        found = {"chunk_sets": schemas.SETS}
        for name, key in (("chunks", "chunks"), ("chunk_embeddings", "embeddings")):
            folders = [r[key] for r in self._all().values() if r[key]]
            found[name] = self.spark.read.parquet(folders[0]).schema if folders else schemas.TABLES[name]
        problems = schemas.drift(found, nullability=False)
        if not problems:
            problems = [d for name, df in zip(("chunk_sets", "chunks", "chunk_embeddings"), self.frames(), strict=True) for d in schemas.nulls(name, df)]
        if problems:
            raise SchemaDrift("; ".join(f"{d.table}.{d.column}: {d.problem}" for d in problems))
