"""Publishing with a ledger: a replayed batch sends nothing twice.

A streaming batch may run again after a failure, and a plain sink would send its
records again. Here a batch is staged first: its values are written once, as
files that stay as they are, so that a replay has the same records in the same
order. Every file is then sent by one task in chunks of ``chunk`` records; after
each acknowledged chunk the task notes in the ledger how many of the file's
records are out. A replay or a retried task goes on behind that number. When a
batch is out, a mark closes it and its staged files may go.

  <folder>/staged/batch=<id>/part-*.parquet
  <folder>/ledger/batch=<id>/<file>.json        batch, file, records, acked
  <folder>/done/batch=<id>.json                 counters of the batch

What remains is the moment between a target's acknowledgement and the note: a
task that dies just there sends one chunk again. Tasks must not be sent twice at
a time (``spark.speculation`` off for this job), as with any target without
transactions. Counters come from the ledger, not from the run: ``totals``.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from crawlmeta.session import ship_package
from crawlmeta.sources.files import list_files, open_input, open_output, open_random

Target = Callable[[], Callable[[list[str]], None]]
_SENT = "file string, records long, sent long"


def file_target(folder: str) -> Target:
    """A target that takes records without asking whether it has them: each chunk is a new file."""
    def opened() -> Callable[[list[str]], None]:
        import uuid

        def send(values: list[str]) -> None:
            with open_output(f"{folder.rstrip('/')}/{uuid.uuid4().hex}.txt") as f:
                f.write("".join(f"{v}\n" for v in values).encode("utf-8"))

        return send

    return opened


def _read_json(path: str) -> dict | None:
    try:
        with open_input(path) as f:
            return json.loads(f.read())
    except (FileNotFoundError, ValueError):  # not there, or not finished: as if never written
        return None


def _write_json(path: str, data: dict) -> None:
    with open_output(path) as f:
        f.write(json.dumps(data).encode("utf-8"))


class Ledger:
    def __init__(self, spark: SparkSession, folder: str, chunk: int = 1000):
        if chunk < 1:
            raise ValueError("chunk must be >= 1")
        self.spark, self.folder, self.chunk = spark, folder.rstrip("/"), chunk

    def _done(self, batch: int) -> str:
        return f"{self.folder}/done/batch={batch}.json"

    def stage(self, values: DataFrame, batch: int, **counts) -> dict:
        """Write the batch's values (column ``value``) unless they are there already; its counters."""
        path, mark = f"{self.folder}/staged/batch={batch}", f"{self.folder}/ledger/batch={batch}/staged.mark"
        found = _read_json(mark)
        if found is not None:
            return found
        obs = Observation()
        (values.observe(obs, F.count(F.lit(1)).alias("rows"), *[c.alias(n) for n, c in counts.items()])
         .where("value IS NOT NULL").select("value").write.mode("overwrite").parquet(path))
        seen = dict(obs.get)
        _write_json(mark, seen)
        return seen

    def send(self, batch: int, target: Target) -> int:
        """Send what the ledger does not have of a staged batch; the number sent now."""
        import pyarrow.parquet as pq
        files = list_files(f"{self.folder}/staged/batch={batch}", suffixes=(".parquet",))
        if not files:
            return 0
        ship_package(self.spark)
        folder, chunk = self.folder, self.chunk

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                for path in pdf.file:
                    name = path.rsplit("/", 1)[-1]
                    note = f"{folder}/ledger/batch={batch}/{name}.json"
                    acked = (_read_json(note) or {}).get("acked", 0)
                    at = sent = 0
                    send = None
                    with open_random(path) as f:
                        parquet = pq.ParquetFile(f)
                        records = parquet.metadata.num_rows
                        for part in parquet.iter_batches(batch_size=chunk, columns=["value"]):
                            values = part.column(0).to_pylist()[max(0, acked - at):]
                            at += part.num_rows
                            if values:
                                send = send or target()
                                send(values)
                                sent += len(values)
                                _write_json(note, {"batch": batch, "file": name, "records": records, "acked": at})
                    yield pd.DataFrame([(name, records, sent)], columns=["file", "records", "sent"])

        paths = self.spark.createDataFrame([(f,) for f in files], "file string").repartition(len(files), "file")
        return paths.mapInPandas(run, _SENT).agg(F.sum("sent")).first()[0] or 0

    def publish(self, values: DataFrame, batch: int, target: Target, **counts) -> int:
        """Stage, send and close a batch; a closed batch sends nothing."""
        if _read_json(self._done(batch)) is not None:
            return 0
        seen = self.stage(values, batch, **counts)
        sent = self.send(batch, target)
        noted = self.notes(batch).agg(F.coalesce(F.sum("acked"), F.lit(0))).first()[0]
        _write_json(self._done(batch), {"batch": batch, **seen, "sent": noted})
        return sent

    def notes(self, batch: int | None = None) -> DataFrame:
        """The ledger: one row per staged file that has begun."""
        path = f"{self.folder}/ledger" + ("" if batch is None else f"/batch={batch}")
        schema = "batch long, file string, records long, acked long"
        if not list_files(path, suffixes=(".json",)):
            return self.spark.createDataFrame([], schema)
        return (self.spark.read.schema(schema).option("recursiveFileLookup", "true")
                .option("pathGlobFilter", "*.json").json(path))

    def totals(self) -> dict:
        """Counters over all closed batches."""
        out: dict = {}
        for path in list_files(f"{self.folder}/done", suffixes=(".json",)):
            for k, v in (_read_json(path) or {}).items():
                if k != "batch":
                    out[k] = out.get(k, 0) + v
        return out
