"""Which stages of a job are done: a stage is keyed by its settings and by the stages it reads.

A stage writes its output under its key and is entered in the ledger last. A job that starts again takes over what is
entered; a stage without an entry is run again and overwrites whatever a stopped run has left. Another input or other
settings give other keys, from the first stage they concern on.
"""

import hashlib
import json
import threading
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from creditmill.sources.store import Store


@dataclass(frozen=True)
class Entry:
    stage: str
    key: str
    path: str
    note: Mapping


class Ledger:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root, self.store = spark, root.rstrip("/"), Store(spark, root)
        self.ran: list[str] = []
        self.reused: list[str] = []
        self._lock = threading.Lock()

    def stage(self, name: str, action: Callable[[str], Mapping | None], settings, after: list[Entry] = ()) -> Entry:
        """Run `action(path)` unless its entry is there. The note it returns, plain JSON, is kept with the entry."""
        told = json.dumps([name, settings, [e.key for e in after]], sort_keys=True, default=str)
        key = hashlib.sha256(told.encode()).hexdigest()[:16]
        path, place = f"{self.root}/stages/{name}/{key}", f"ledger/{name}-{key}.json"
        text = self.store.get(place)
        if text is None:
            text = json.dumps(action(path) or {})
            try:
                self.store.put(place, text)
            except FileExistsError:  # a second job did the same meanwhile
                text = self.store.get(place)
            done = self.ran
        else:
            done = self.reused
        with self._lock:
            done.append(name)
        return Entry(name, key, path, json.loads(text))

    def read(self, entry: Entry, part: str = "") -> DataFrame:
        return self.spark.read.parquet(f"{entry.path}/{part}" if part else entry.path)
