"""Rows scored by a saved model."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadlens.operators.models import load_model
from threadlens.sources.results import save_results

READ = ("inputCol", "featuresCol")
MADE = ("outputCol", "predictionCol", "probabilityCol", "rawPredictionCol")
RESULTS = ("prediction", "predicted_label")


def _named(step, names: Sequence[str]) -> list[str]:
    return [step.getOrDefault(n) for n in names if step.hasParam(n) and step.isDefined(n)]


def scoring_steps(model) -> list:
    """The steps of a model that lead to its prediction; codes of the label are for fitting only."""
    wanted, kept = set(RESULTS), []
    for step in reversed(getattr(model, "stages", [model])):
        if wanted & set(_named(step, MADE)):
            kept.insert(0, step)
            wanted.update(_named(step, READ))
    if not kept:
        raise ValueError("the model makes no prediction")
    return kept


def inputs_of(model) -> dict[str, T.DataType]:
    """The columns a model needs to predict and none of its steps makes: vectors, or else texts."""
    made: set[str] = set()
    needed: dict[str, T.DataType] = {}
    for step in scoring_steps(model):
        for param in READ:
            for column in _named(step, [param]):
                if column not in made:
                    needed[column] = VectorUDT() if param == "featuresCol" else T.StringType()
        made.update(_named(step, MADE))
    return needed


def check_inputs(model, rows: DataFrame) -> dict[str, T.DataType]:
    """``inputs_of`` the model, once the rows are known to have them; a ``ValueError`` names those that fail."""
    needed = inputs_of(model)
    given = {field.name: field.dataType for field in rows.schema.fields}
    wrong = [
        f"{name}: {given[name].simpleString() if name in given else 'missing'} instead of {kind.simpleString()}"
        for name, kind in needed.items()
        if given.get(name) != kind
    ]
    if wrong:
        raise ValueError("the model cannot read these rows: " + "; ".join(wrong))
    return needed


def predicted(model, rows: DataFrame, keep: Sequence[str]) -> DataFrame:
    """The columns ``keep`` of every row with the model's ``prediction`` (and ``predicted_label``).

    Nothing is shuffled: rows are scored where they are read. A row with a NULL input has no
    prediction. Other columns are not handed to the model, so their names cannot clash.
    """
    needed = check_inputs(model, rows)
    model = PipelineModel(stages=scoring_steps(model))
    kept = {f"_kept_{k}": name for k, name in enumerate(keep)}
    known = F.lit(True)
    for name in needed:
        known &= F.col(f"`{name}`").isNotNull()
    inputs = [F.col(f"`{name}`").alias(name) for name in needed]
    rows = rows.select(*[F.col(f"`{name}`").alias(k) for k, name in kept.items()], *inputs, known.alias("_known"))
    texts = {name: F.coalesce(name, F.lit("")) for name, kind in needed.items() if kind == T.StringType()}
    if len(texts) == len(needed):
        scored = model.transform(rows.withColumns(texts))
    else:
        scored = model.transform(rows.filter("_known")).unionByName(rows.filter("not _known"), allowMissingColumns=True)
    found = [F.when(F.col("_known"), F.col(name)).alias(name) for name in RESULTS if name in scored.columns]
    return scored.select(*[F.col(k).alias(name) for k, name in kept.items()], *found)


def prediction_job(path: str, rows: DataFrame, keep: Sequence[str], folder: str, by: Sequence[str] = ()) -> None:
    """Score rows by the model saved at ``path`` and write ``predictions`` below ``folder``.

    ``by`` are kept columns to lay the table out by; a rerun replaces their partitions alone.
    """
    table = predicted(load_model(path), rows, keep)
    save_results({"predictions": table}, folder, {"predictions": by} if by else None)
