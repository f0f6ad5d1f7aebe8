"""All tables of the job published at once.

Every run writes its tables to a folder of its own, tests them there, and one pointer then
switches readers to all of them. A run that fails, or whose data tests find violations, leaves
readers where they were; readers of the version before the last keep their files until
``drop_old_versions``.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from paceline.plans.build import build_tables, check_tables, evaluate
from paceline.operators import quality
from paceline.sources.scratch import delete_folder, subfolders
from paceline.spec import DEFAULT_EXPERIMENT, DEFAULT_FUNNEL, ExperimentSpec, FunnelSpec
from paceline.streaming.keyed import Pointer


class Publication:
    """Versions of a set of tables below ``path`` and the pointer to the one in force."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self.pointer = Pointer(spark, f"{path}/current", "folder string, table_name string")

    def new_version(self) -> str:
        """A folder no reader knows."""
        return f"{self.path}/versions/{uuid.uuid4().hex}"

    def publish(self, folder: str, names: list[str]) -> None:
        """Makes the tables written below ``folder`` the ones that are read, all together."""
        self.pointer.put([(folder.rsplit("/", 1)[1], n) for n in sorted(names)])

    def tables(self) -> dict[str, DataFrame]:
        """The published tables, all of one version; empty before the first publication."""
        known = self.pointer.versions()
        return {r["table_name"]: self.spark.read.parquet(f"{self.path}/versions/{r['folder']}/{r['table_name']}")
                for r in (known[0][1] if known else [])}

    def drop_old_versions(self) -> list[str]:
        """Deletes the folders of versions older than the last two, and of runs that failed; none may be under way."""
        kept = {r["folder"] for _, rows in self.pointer.versions() for r in rows}
        gone = [f for f in subfolders(self.spark, f"{self.path}/versions") if f not in kept]
        for folder in gone:
            delete_folder(self.spark, f"{self.path}/versions/{folder}")
        return gone


def publish_tables(spark: SparkSession, stg: DataFrame, path: str, *, fail_on_violation: bool = True,
                   spec: FunnelSpec = DEFAULT_FUNNEL, exp: ExperimentSpec = DEFAULT_EXPERIMENT) -> Mapping[str, DataFrame]:
    """Builds, tests, evaluates and publishes; what is published if all went well.

    Raises ``DataTestFailure`` with the old version still in force where a data test finds
    violations, unless told to publish nevertheless.
    """
    publication = Publication(spark, path)
    folder = publication.new_version()
    watched = quality.Watched(spec)
    tables = build_tables(stg, folder, spec, watched)
    for name in ("int_sessions", "int_step_transition"):  # views so far, unless the general join was needed
        if name not in subfolders(spark, folder):
            tables[name].write.parquet(f"{folder}/{name}")
    if fail_on_violation:
        check_tables(tables, folder, spec, watched)
    else:
        quality.run_suite(tables, spec, watched=watched).write.mode("overwrite").parquet(f"{folder}/data_tests")
    made = evaluate(tables, folder, exp, spec)
    publication.publish(folder, [*tables, "data_tests", *made])
    return publication.tables()

