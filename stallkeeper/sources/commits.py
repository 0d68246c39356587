"""A log of commits: numbered files, each created only if no one else has taken its number.

A commit is optimistic. Who wants one reads the log (a snapshot), does the work, and puts the file of the next
number. If that number is gone, others have committed meanwhile, and what the work rests on has
to be looked at again. Readers see whole files only: a file counts once its last line is ``END``, so a
writer that dies while it writes has committed nothing.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from stallkeeper.sources.storage import create_new, exists, names_in

END = "{}"
DIGITS = 12


class CommitLog:
    """Rows of one schema in numbered JSON files below a folder."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema

    def version(self) -> int:
        """The last number that is taken, 0 for none."""
        names = names_in(self.spark, self.path) if exists(self.spark, self.path) else []
        return max((int(n[:DIGITS]) for n in names if n.endswith(".json")), default=0)

    def read(self, version: int | None = None) -> DataFrame:
        """Rows of the commits up to ``version``; ``seq`` is their number unless they bring one."""
        number = F.regexp_extract(F.col("_metadata.file_path"), rf"(\d{{{DIGITS}}})\.json$", 1)
        if not self.version():
            return self.spark.createDataFrame([], self.schema)
        lines = self.spark.read.text(f"{self.path}/*.json").select(
            "value", number.cast("long").alias("seq")
        )
        if version is not None:
            lines = lines.filter(F.col("seq") <= version)
        whole = lines.filter(F.col("value") == END).select("seq")
        rows = lines.filter(F.col("value") != END).join(F.broadcast(whole), "seq", "left_semi")
        parsed = rows.select("seq", F.from_json("value", self.schema).alias("row"))
        own = F.coalesce("row.seq", "seq").alias("seq")
        rest = (f"row.{n}" for n in self.schema.fieldNames() if n != "seq")
        return parsed.select(*rest, own).select(*self.schema.fieldNames())

    def put(self, version: int, rows: list[dict]) -> bool:
        """Commit rows under a number; False if it is taken. A commit is of a bounded number of rows."""
        text = "".join(json.dumps(row) + "\n" for row in rows) + END + "\n"
        return create_new(self.spark, f"{self.path}/{version:0{DIGITS}d}.json", text)
