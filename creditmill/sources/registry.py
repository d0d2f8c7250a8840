"""Versioned models, and a pointer to the one that is served.

A version is a folder with the model and a card. The card is written last, so a version without one is the rest of a
stopped job and is written again. Promotion adds a numbered pointer; the highest is in force, so serving moves from one
whole model to another in one step, and the pointers that came before are the history.
"""

import json
from collections.abc import Mapping, Sequence
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession

from creditmill.operators import models
from creditmill.sources.store import Store

CARDS = ("version string, name string, calibrated boolean, run string, parent string, metrics map<string,double>, "
         "params map<string,string>, features array<string>")


class StaleBest(RuntimeError):
    """Another model was promoted since the caller looked."""


@dataclass(frozen=True)
class Card:
    """What a version is: which specification and parameters it was fitted with, how it scored, what it was made from."""

    version: str
    name: str
    calibrated: bool = False
    run: str = ""
    parent: str = ""
    metrics: Mapping[str, float] = field(default_factory=dict)
    params: Mapping = field(default_factory=dict)
    features: Sequence[str] = ()


class Registry:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root, self.store = spark, root.rstrip("/"), Store(spark, root)

    def _model(self, version: str) -> str:
        return f"{self.root}/versions/{version}/model"

    def card(self, version: str) -> Card | None:
        text = self.store.get(f"versions/{version}/card.json")
        return None if text is None else Card(**json.loads(text))

    def register(self, model, card: Card) -> Card:
        """Save a model under its card's version. A version that is already whole stays as it is."""
        there = self.card(card.version)
        if there is not None:
            return there
        models.save_model(model, self._model(card.version))
        self.store.put(f"versions/{card.version}/card.json", json.dumps(asdict(card)))
        return card

    def load(self, version: str | None = None):
        """(model, card) of a version, by default of the one in force."""
        card = self.current() if version is None else self.card(version)
        if card is None:
            raise LookupError(f"no such model: {version or 'nothing was promoted'}")
        return models.load_model(self._model(card.version), card.calibrated), card

    def _pointers(self) -> list[str]:
        return self.store.names("pointers")

    def current(self) -> Card | None:
        pointers = self._pointers()
        return self.card(json.loads(self.store.get(f"pointers/{pointers[-1]}"))["version"]) if pointers else None

    def promote(self, version: str, instead_of: str | None = None) -> Card:
        """Serve a whole version from now on. Doing so again changes nothing; with `instead_of`, only if that one is in force."""
        card, now = self.card(version), self.current()
        if card is None:
            raise LookupError(f"no such model: {version}")
        if now is not None and now.version == version:
            return card
        if instead_of is not None and (now is None or now.version != instead_of):
            raise StaleBest(f"{now.version if now else 'nothing'} is in force, not {instead_of}")
        try:
            self.store.put(f"pointers/{len(self._pointers()) + 1:09d}.json", json.dumps({"version": version}))
        except FileExistsError as e:
            raise StaleBest("another model was promoted at the same time") from e
        return card

    def history(self) -> list[str]:
        """Versions in the order they were promoted."""
        return [json.loads(self.store.get(f"pointers/{p}"))["version"] for p in self._pointers()]

    def versions(self) -> DataFrame:
        """One row per whole version, with the place of its last promotion (null if it never was) and whether it is in force."""
        cards = [c for v in self.store.names("versions") if (c := self.card(v)) is not None]
        history = self.history()
        place = {v: i + 1 for i, v in enumerate(history)}
        rows = [(c.version, c.name, c.calibrated, c.run, c.parent, {k: float(v) for k, v in c.metrics.items()},
                 {k: str(v) for k, v in c.params.items()}, list(c.features), place.get(c.version), c.version == (history or [None])[-1])
                for c in cards]
        return self.spark.createDataFrame(rows, CARDS + ", promoted int, in_force boolean")
