"""Tables that micro-batches add to and that are merged now and then.

A batch writes its rows to `batches/batch_id=N`, so a batch that is replayed overwrites them. Every `merge_every` batches
the rows since the last merge are merged into sections (a date, say); only sections with new rows are written anew, under
`merged/upto-N/_section=S`. A manifest, which appears last and whole, names the folder of every section and the last
batch in them. Folders that neither of the two newest manifests names are deleted, so a reader that began before a merge
can finish; batches up to the manifest's last one are not read any more, whatever a replay writes there.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from metricloom.plans.workspace import delete_folder, file_names, publish_file, subfolders

MERGE_EVERY = 16


@dataclass(frozen=True)
class LogTable:
    """`merged` makes one row of the versions of a row, which `batch_id` tells apart; it keeps that column.

    `section` is a text column that the versions of a row agree in; a batch touches few of its values.
    """

    spark: SparkSession
    path: str
    merged: Callable[[DataFrame], DataFrame]
    section: Column

    def add(self, rows: DataFrame, batch_id: int, merge_every: int = MERGE_EVERY) -> None:
        rows.write.mode("overwrite").parquet(f"{self.path}/batches/batch_id={batch_id}")
        if (batch_id + 1) % merge_every == 0:
            self.merge(batch_id)

    def read(self) -> DataFrame:
        return self.merged(self._versions(self._manifests(1)[0], None)).drop("batch_id")

    def _manifests(self, wanted: int) -> list[dict]:
        """The newest manifests, the newest first; an empty table where there is none."""
        names = sorted(n for n in file_names(self.spark, f"{self.path}/manifests") if n.startswith("manifest-"))[::-1][:wanted]
        read = [json.loads(self.spark.read.text(f"{self.path}/manifests/{n}", wholetext=True).first()[0]) for n in names]
        return read or [{"upto": -1, "sections": {}}]

    def _versions(self, manifest: dict, last: int | None, sections: list[str] | None = None) -> DataFrame:
        """Rows of the manifest's sections, all or those named, and of the batches after it, up to `last`."""
        folders = [f"{self.path}/{folder}" for name, folder in manifest["sections"].items() if sections is None or name in sections]
        batches = [int(n[9:]) for n in subfolders(self.spark, f"{self.path}/batches") if n.startswith("batch_id=")]
        batches = [b for b in batches if b > manifest["upto"] and (last is None or b <= last)]
        found = [self.spark.read.parquet(*folders)] if folders else []
        if batches:
            base = self.spark.read.option("basePath", f"{self.path}/batches")
            found.append(base.parquet(*[f"{self.path}/batches/batch_id={b}" for b in batches]))
        return reduce(DataFrame.unionByName, [t.withColumn("batch_id", F.col("batch_id").cast("long")) for t in found])

    def merge(self, batch_id: int) -> None:
        """Merge everything up to a batch; nothing where that is done."""
        manifest, *before = self._manifests(2)
        if manifest["upto"] >= batch_id:
            return
        fresh = self._versions({**manifest, "sections": {}}, batch_id)
        touched = sorted(r.s for r in fresh.select(self.section.alias("s")).distinct().collect())
        target = f"merged/upto-{batch_id}"
        rows = self.merged(self._versions(manifest, batch_id, touched))
        rows.withColumn("_section", self.section).write.mode("overwrite").partitionBy("_section").parquet(f"{self.path}/{target}")
        known = {"upto": batch_id, "sections": manifest["sections"] | {s: f"{target}/_section={s}" for s in touched}}
        publish_file(self.spark, f"{self.path}/manifests/manifest-{batch_id:012d}.json", json.dumps(known))
        named = {*known["sections"].values(), *manifest["sections"].values()}
        for old in before:
            for folder in {*old["sections"].values()} - named:
                delete_folder(self.spark, f"{self.path}/{folder}")
            delete_folder(self.spark, f"{self.path}/manifests/manifest-{old['upto']:012d}.json")
        for name in subfolders(self.spark, f"{self.path}/merged"):
            if not any(folder.startswith(f"merged/{name}/") for folder in named):
                delete_folder(self.spark, f"{self.path}/merged/{name}")
        for name in subfolders(self.spark, f"{self.path}/batches"):
            if name.startswith("batch_id=") and int(name[9:]) <= manifest["upto"]:
                delete_folder(self.spark, f"{self.path}/batches/{name}")
