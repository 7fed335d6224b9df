"""The declared embedding model, bound to a way of calling it.  Vectors of another model
give distances that look right and mean nothing, so the model comes from the store."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame

from folioscope.sources.files import only_row
from folioscope.streaming.journal import embed_pending

Call = Callable[[str, list[str]], list[list[float]]]


class EmbedderUnavailable(RuntimeError):
    """Asked for a vector that must be there, and the model can't be reached."""


@dataclass(frozen=True)
class Embedder:
    """``call`` takes the model's name and texts and returns a vector for each."""

    model: str
    dims: int
    call: Call

    @classmethod
    def declared(cls, models: DataFrame, call: Call) -> Embedder | None:
        """models (model, dims) has one row at most; None where it has none."""
        row = only_row(models.select("model", "dims"), 2)
        return None if row is None else cls(row["model"], int(row["dims"]), call)

    def query(self, text: str) -> list[float] | None:
        """Vector of one question, None if the model can't be reached or has no answer: a
        search then falls back to full text.  Another width is an error all the same."""
        try:
            vector = self.call(self.model, [text])[0]
        except (OSError, KeyError, IndexError):
            return None
        if len(vector) != self.dims:
            raise ValueError(f"{self.model} gave {len(vector)} dimensions, {self.dims} are declared: embed the store again")
        return vector

    def required(self, text: str) -> list[float]:
        """As ``query``, for graph questions, which have nothing to fall back to."""
        vector = self.query(text)
        if vector is None:
            raise EmbedderUnavailable(f"{self.model} gave no vector")
        return vector

    def table(self, rows: DataFrame, batch: int = 16) -> DataFrame:
        """(id, text) -> (id, embedding) on the executors.  Whatever goes wrong raises, so no
        level of a crawl is dropped for want of vectors."""
        model, call = self.model, self.call
        return embed_pending(rows, lambda texts: call(model, texts), self.dims, batch)
