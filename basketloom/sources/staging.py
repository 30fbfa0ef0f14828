"""Tables written once to the shared folder and read back by every later query."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from ..schemas import Tables
from ..session import remove_path, shared_dir, use_sql_defaults
from .warehouse import read_warehouse, warehouse_lines


class Stage:
    """A run-scoped set of parquet tables in shared storage.

    Reading a table back cuts its lineage, survives the loss of executors, and gives the optimizer
    real sizes: whether a join broadcasts is then decided by the measured size of the table.
    """

    def __init__(self, spark: SparkSession, name: str = "stage"):
        self.spark = spark
        app = spark.sparkContext.applicationId
        self.root = f"{shared_dir(spark)}/{name}-{app}-{uuid.uuid4().hex[:8]}"
        self._frames: dict[str, DataFrame] = {}
        self._kept: dict[str, object] = {}

    def __enter__(self) -> Stage:
        return self

    def __exit__(self, *_) -> None:
        self.close()

    def close(self) -> None:
        """Remove everything that was written; frames handed out cannot be read after that."""
        self._frames.clear()
        self._kept.clear()
        remove_path(self.spark, self.root)

    def once(self, name: str, build: Callable[[], object]) -> object:
        """What ``build`` returned the first time under ``name``: a fitted model, for one."""
        if name not in self._kept:
            self._kept[name] = build()
        return self._kept[name]

    def table(
        self, name: str, build: Callable[[], DataFrame], partition_by: Sequence[str] = ()
    ) -> DataFrame:
        """The table called ``name``, built and written on first use.

        What the table is made from belongs in its name; see ``fingerprint``.
        """
        if name not in self._frames:
            path = f"{self.root}/{name}"
            built = build()
            built.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
            # The schema is known, so reading back needs no inference job.
            self._frames[name] = self.spark.read.schema(built.schema).parquet(path)
        return self._frames[name]


def fingerprint(tables: Tables) -> str:
    """Tells inputs apart in the names of staged tables: equal plans over equal folders are equal."""
    return "-".join(f"{df.semanticHash() & 0xFFFFFFFF:08x}" for _, df in tables.items())


class WarehouseStage(Stage):
    """Input tables derived from a warehouse folder, staged one by one as queries need them."""

    def __init__(self, spark: SparkSession, folder: str):
        super().__init__(spark, "basketloom")
        self.folder = folder
        self._lazy: Tables | None = None

    @property
    def derived(self) -> Tables:
        if self._lazy is None:
            self._lazy = read_warehouse(self.spark, self.folder)
        return self._lazy

    @property
    def orders(self) -> DataFrame:
        return self.table("orders", lambda: self.derived.orders)

    @property
    def lines(self) -> DataFrame:
        def build() -> DataFrame:
            raw = self.spark.read.parquet(f"{self.folder}/lineitem.parquet")
            return warehouse_lines(raw, self.orders)

        # Prior and train lines are read apart: a folder each, so neither scan touches the other.
        return self.table("lines", build, partition_by=["eval_set"])

    @property
    def prior(self) -> DataFrame:
        return self.lines.where("eval_set = 'prior'").drop("eval_set")

    @property
    def train(self) -> DataFrame:
        return self.lines.where("eval_set = 'train'").drop("eval_set")

    @property
    def products(self) -> DataFrame:
        return self.table("products", lambda: self.derived.products)

    @property
    def aisles(self) -> DataFrame:
        return self.table("aisles", lambda: self.derived.aisles)

    @property
    def departments(self) -> DataFrame:
        return self.table("departments", lambda: self.derived.departments)

    def tables(self) -> Tables:
        return Tables(
            self.orders, self.prior, self.train, self.products, self.aisles, self.departments
        )


# The files a warehouse stage is derived from.
INPUTS = ("orders", "lineitem", "part")


def input_files(
    spark: SparkSession, folder: str, names: Sequence[str] = INPUTS
) -> list[tuple[str, int, int]]:
    """Path, size and time of every input file.

    Files are listed by the storage system that holds them; contents are not read.
    """
    found = []
    for name in names:
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}.parquet")
        listed = path.getFileSystem(spark._jsc.hadoopConfiguration()).listFiles(path, True)
        while listed.hasNext():
            file = listed.next()
            found.append((file.getPath().toString(), file.getLen(), file.getModificationTime()))
    return sorted(found)


def manifest(spark: SparkSession, folder: str, names: Sequence[str] = INPUTS) -> str:
    """A digest of ``input_files``: another one when a file changes."""
    return hashlib.sha256(repr(input_files(spark, folder, names)).encode()).hexdigest()


_stages: dict[tuple[str, str], tuple[str, WarehouseStage]] = {}


def stage_for(spark: SparkSession, folder: str) -> WarehouseStage:
    """The stage of this application for the files now in ``folder``.

    When a file has changed, a new stage takes the place of the old one, whose tables are removed.
    """
    key = (spark.sparkContext.applicationId, folder)
    now = manifest(spark, folder)
    made, stage = _stages.get(key, ("", None))
    if made != now:
        if stage is not None:
            stage.close()
        use_sql_defaults(spark, sum(size for _, size, _ in input_files(spark, folder)))
        stage = WarehouseStage(spark, folder)
        _stages[key] = now, stage
    return stage


def close_stages(spark: SparkSession) -> None:
    """Remove the tables of all stages of this application."""
    for key in [k for k in _stages if k[0] == spark.sparkContext.applicationId]:
        _stages.pop(key)[1].close()
