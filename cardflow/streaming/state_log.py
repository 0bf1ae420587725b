"""Card states as Parquet files: a base and a short tail.

Every micro-batch adds the new states of the cards it changed as one part of the tail, under
tail/run=<r>/batch_id=<b>; the state of a card is its newest row. After every `merge_every` batches
of a run the batch's own job also writes a new base: all states, split by a hash of the card. So a
batch reads the splits of one base that its cards fall in and fewer than 2 * `merge_every` small
parts, however old the stream is. What no batch can read any more is deleted.

A batch reads only what was written before it, so running it again, after any failure, gives the
same rows in the same place. A base counts once its marker file is there.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardflow.plans.workspace import children, exists, remove, touch
from cardflow.schema import STATE_COLUMNS, STATE_SCHEMA

_PLACE = [T.StructField("run", T.LongType()), T.StructField("batch_id", T.LongType())]
TAIL_SCHEMA = T.StructType([*STATE_SCHEMA.fields, *_PLACE])
BASE_SCHEMA = T.StructType([*TAIL_SCHEMA.fields, T.StructField("bucket", T.LongType())])
SEED_RUN = 0
MARKER = "_whole"

Place = tuple[int, int]  # run and batch


@dataclass(frozen=True)
class StateLog:
    path: str
    buckets: int = 64
    merge_every: int = 10

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64("card_id"), F.lit(self.buckets))

    def _at(self, kind: str, place: Place) -> str:
        return f"{self.path}/{kind}/run={place[0]}/batch_id={place[1]}"

    def _places(self, spark: SparkSession, kind: str) -> list[Place]:
        """Runs and batches with a folder, in order."""
        found = []
        for run in children(spark, f"{self.path}/{kind}"):
            for batch in children(spark, f"{self.path}/{kind}/{run}"):
                found.append((int(run.split("=")[1]), int(batch.split("=")[1])))
        return sorted(found)

    def _bases(self, spark: SparkSession) -> list[Place]:
        return [p for p in self._places(spark, "base") if exists(spark, f"{self._at('base', p)}/{MARKER}")]

    def write(self, states: DataFrame, run: int, batch_id: int) -> None:
        """Adds one batch of states, replacing an earlier attempt at the same batch, and merges when
        it is time."""
        spark, here = states.sparkSession, (run, batch_id)
        out = states.select(*STATE_COLUMNS).hint("rebalance")  # as few files as their size allows
        out.write.mode("overwrite").parquet(self._at("tail", here))
        if (batch_id + 1) % self.merge_every == 0:
            # up to and with this batch
            self._write_base(self.before(spark, run, batch_id + 1, own_base=False), here)
            self._forget(spark, here)

    def _write_base(self, states: DataFrame, place: Place) -> None:
        (
            states.select(*STATE_COLUMNS)
            .withColumn("bucket", self.bucket())
            .repartition("bucket")
            .write.mode("overwrite")
            .partitionBy("bucket")
            .parquet(self._at("base", place))
        )
        touch(states.sparkSession, f"{self._at('base', place)}/{MARKER}")

    def _forget(self, spark: SparkSession, newest: Place) -> None:
        """Deletes what is older than the base before `newest`, from which a repeated batch reads."""
        earlier = [p for p in self._bases(spark) if p < newest]
        if not earlier:
            return
        for place in self._places(spark, "base"):
            if place < earlier[-1]:
                remove(spark, self._at("base", place))
        for place in self._places(spark, "tail"):
            if place <= earlier[-1]:
                remove(spark, self._at("tail", place))

    def seed(self, spark: SparkSession, states: DataFrame | None = None) -> None:
        """Starts the table, from batch states or empty. Streams use runs from 1 on."""
        if states is None:
            states = spark.createDataFrame([], STATE_SCHEMA)
        self._write_base(states, (SEED_RUN, 0))

    def current(self, spark: SparkSession) -> DataFrame:
        return self._as_of(spark, None, None)

    def before(
        self,
        spark: SparkSession,
        run: int,
        batch_id: int,
        buckets: list[int] | None = None,
        own_base: bool = True,
    ) -> DataFrame:
        """States as of the start of a batch, of the cards of some buckets at least. Without
        `own_base` the base of the batch before, if there is one, is not used."""
        return self._as_of(spark, (run, batch_id), buckets, own_base)

    def _as_of(
        self, spark: SparkSession, end: Place | None, buckets: list[int] | None, own_base: bool = True
    ) -> DataFrame:
        base, tail = self.parts(spark, end, own_base)
        rows = (
            spark.read.schema(BASE_SCHEMA)
            .option("basePath", f"{self.path}/base")
            .parquet(self._at("base", base))
        )
        if buckets is not None:
            rows = rows.where(F.col("bucket").isin(buckets))
        rows = rows.drop("bucket")
        if tail:
            rows = rows.unionByName(
                spark.read.schema(TAIL_SCHEMA)
                .option("basePath", f"{self.path}/tail")
                .parquet(*[self._at("tail", p) for p in tail])
            )
        return _newest(rows) if tail else rows.select(*STATE_COLUMNS)

    def parts(
        self, spark: SparkSession, end: Place | None = None, own_base: bool = True
    ) -> tuple[Place, list[Place]]:
        """The base and the parts of the tail that hold the states before `end` (now, if None).
        Fails if the table was never seeded."""
        last = None if end is None or own_base else (end[0], end[1] - 1)
        bases = [
            p for p in self._bases(spark) if (end is None or p < end) and (last is None or p < last)
        ]
        if not bases:
            raise FileNotFoundError(f"PATH_NOT_FOUND: no state table at {self.path}; seed it first")
        tail = self._places(spark, "tail")
        return bases[-1], [p for p in tail if bases[-1] < p and (end is None or p < end)]

    def check_run(self, spark: SparkSession, run: int, batch_id: int) -> None:
        """A run belongs to one checkpoint: its batches come in order, so later ones mean that
        a new checkpoint was started under an old run number. What a higher run wrote is newer than
        anything of this one."""
        base, tail = self.parts(spark)
        if max([base, *tail]) > (run, batch_id):
            raise ValueError(f"run {run} is already past batch {batch_id}; use a higher run")

    def compact(self, spark: SparkSession, path: str) -> StateLog:
        """A new table at `path` that starts from the current states. This one is left alone."""
        target = StateLog(path, self.buckets, self.merge_every)
        target.seed(spark, self.current(spark))
        return target


def _newest(rows: DataFrame) -> DataFrame:
    newest = rows.groupBy("card_id").agg(
        F.max_by(F.struct(*STATE_COLUMNS[1:]), F.struct("run", "batch_id")).alias("_s")
    )
    return newest.select("card_id", "_s.*")
