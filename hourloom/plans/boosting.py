"""Gradient boosting round by round with MLlib trees: stops with patience, and can go on from where it ended.

MLlib boosts a fixed number of rounds, two classes only, and cannot start from an earlier model. Here every round fits
one MLlib regression tree for each output on the gradient of a loss that all outputs share. The rows are stored once.
Predictions so far (margins) lie beside them in memory, anew every few rounds; those of the few trees since then are one
more expression, so the plan does not grow with the rounds and no round copies the features. What comes out are MLlib's
own boosted models, one for each output.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.ml.regression import DecisionTreeRegressionModel, GBTRegressionModel, RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hourloom.operators.sampling import SEED
from hourloom.plans.training import KEYS
from hourloom.session import stored_meanwhile

HELD_OUT = "__held_out"
_LABEL, _TARGET, _WEIGHT, _STEP = "__label", "__target", "__weight", "__step"
#: Parts of a thousand in which the row sample is counted, and rows below which a sample might come out empty.
_PARTS, _FEW = 1000, 1000
#: A softmax step is cut at this many units: where a class is all but certain, the second-order step has no bound.
_LONGEST = 4.0
_LEAST_PROBABILITY = 1e-15


@dataclass(frozen=True)
class BoostSettings:
    rounds: int
    patience: int
    depth: int = 8
    step: float = 0.05
    share_of_rows: float = 0.8
    share_of_columns: float = 0.8
    seed: int = SEED
    #: Rounds after which the margins are kept anew.
    stored_every: int = 10


class AbsoluteLoss:
    """Mean absolute error of one number. The first tree takes the label itself, in full; later ones the sign of what is left.

    ``unit`` is what a leaf of one sign adds for a step of 1: with the label's spread, steps suit a label of any size. MLlib's own
    boosting has a unit of 1 and a first tree as deep as the others; ``first_depth`` 0 starts from the mean.
    """

    outputs = 1

    def __init__(self, unit: float = 1.0, first_depth: int | None = None) -> None:
        self.unit, self.first_depth = unit, first_depth

    def depth(self, number: int, depth: int) -> int:
        return depth if number or self.first_depth is None else self.first_depth

    def weight(self, number: int, step: float) -> float:
        return 1.0 if number == 0 else step * self.unit

    def targets(self, label: Column, margins: list[Column], number: int) -> list[tuple[Column, Column | None]]:
        if number == 0:
            return [(label, None)]
        return [(F.when(label < margins[0], -1.0).otherwise(1.0), None)]

    def loss(self, label: Column, margins: list[Column]) -> Column:
        return F.abs(label - margins[0])


class SoftmaxLoss:
    """Log loss of classes 0..n-1 whose margins compete in one softmax.

    The trees take second-order steps: a row's target is its gradient over twice the variance p(1 - p), which bounds the curvature
    that classes share, and its weight is that variance; a leaf's weighted mean is then the leaf's step.
    """

    def __init__(self, classes: int) -> None:
        self.outputs = classes

    def depth(self, number: int, depth: int) -> int:
        return depth

    def weight(self, number: int, step: float) -> float:
        return step

    def probability(self, margins: list[Column], k: int) -> Column:
        total = F.lit(0.0)
        for margin in margins:
            total = total + F.exp(margin - margins[k])
        return 1.0 / total

    def targets(self, label: Column, margins: list[Column], number: int) -> list[tuple[Column, Column | None]]:
        found = []
        for k in range(self.outputs):
            p = self.probability(margins, k)
            spread = F.greatest(2.0 * p * (1.0 - p), F.lit(_LEAST_PROBABILITY))
            gradient = F.when(label == k, 1.0 - p).otherwise(-p)
            found.append((F.greatest(F.least(gradient / spread, F.lit(_LONGEST)), F.lit(-_LONGEST)), spread))
        return found

    def loss(self, label: Column, margins: list[Column]) -> Column:
        own = F.lit(None).cast("double")
        for k in range(self.outputs):
            own = F.when(label == k, self.probability(margins, k)).otherwise(own)
        return -F.log(F.greatest(own, F.lit(_LEAST_PROBABILITY)))


def best_rounds(losses: list[float], patience: int) -> int:
    """Rounds up to the least loss, not looking beyond ``patience`` rounds without a better one."""
    best = 0
    for i, loss in enumerate(losses):
        if loss < losses[best]:
            best = i
        elif i - best >= patience:
            break
    return best + 1


def _boosted_model(trees: list[DecisionTreeRegressionModel], weights: list[float]) -> GBTRegressionModel:
    """MLlib's model of these trees."""
    spark = SparkSession.active()
    gateway, regression = spark.sparkContext._gateway, spark._jvm.org.apache.spark.ml.regression
    kept, steps = gateway.new_array(regression.DecisionTreeRegressionModel, len(trees)), gateway.new_array(gateway.jvm.double, len(trees))
    for i, (tree, weight) in enumerate(zip(trees, weights)):
        kept[i], steps[i] = tree._java_obj, weight
    return GBTRegressionModel(regression.GBTRegressionModel(f"boosted_{uuid.uuid4().hex[:12]}", kept, steps, trees[0].numFeatures))


@dataclass
class Boosted:
    """Trees by round and output, the weight of each round, and the hold-out loss after it (none without such rows)."""

    patience: int
    rounds: list[list[DecisionTreeRegressionModel]] = field(default_factory=list)
    weights: list[float] = field(default_factory=list)
    losses: list[float] = field(default_factory=list)

    @property
    def best(self) -> int:
        return best_rounds(self.losses, self.patience) if self.losses else len(self.rounds)

    @property
    def ended(self) -> bool:
        return bool(self.losses) and len(self.losses) - self.best >= self.patience

    def models(self, rounds: int | None = None) -> list[GBTRegressionModel]:
        """One model for each output, of its first ``rounds`` rounds; of the best ones by default."""
        rounds = self.best if rounds is None else rounds
        return [_boosted_model([r[k] for r in self.rounds[:rounds]], self.weights[:rounds]) for k in range(len(self.rounds[0]))]


def restart(models: Iterable[GBTRegressionModel], patience: int, losses: Iterable[float] = ()) -> Boosted:
    """The state at the end of stored models, to go on from; ``losses`` are those of their rounds, if kept."""
    models = list(models)
    rounds = [list(r) for r in zip(*[m.trees for m in models])]
    return Boosted(patience, rounds, list(models[0].treeWeights), list(losses)[: len(rounds)])


def _margin(k: int) -> str:
    return f"__margin_{k}"


def _grown(rows: DataFrame, state: Boosted, first: int, outputs: int) -> DataFrame:
    """``rows`` with the margins after all rounds, from those after the ``first`` ones: one expression, however many trees follow."""
    if first == len(state.rounds):
        return rows
    for k in range(outputs):
        model = _boosted_model([r[k] for r in state.rounds[first:]], state.weights[first:])
        stepped = model.transform(rows, {model.predictionCol: _STEP})
        rows = stepped.withColumn(_margin(k), F.col(_margin(k)) + F.col(_STEP)).drop(_STEP)
    return rows


def _sampled(train: DataFrame, settings: BoostSettings, number: int, few: bool) -> DataFrame:
    """The rows of a round, by a hash of key and round: the same on any layout of the rows."""
    if settings.share_of_rows >= 1:
        return train
    picked = F.pmod(F.xxhash64(*KEYS, F.lit(settings.seed + number)), F.lit(_PARTS)) < round(settings.share_of_rows * _PARTS)
    chosen = train.where(picked)
    return train if few and chosen.isEmpty() else chosen


def _round(train: DataFrame, loss, settings: BoostSettings, number: int, few: bool) -> list[DecisionTreeRegressionModel]:
    margins = [F.col(_margin(k)) for k in range(loss.outputs)]
    rows = _sampled(train, settings, number, few)

    def fit(k: int) -> DecisionTreeRegressionModel:
        target, weight = loss.targets(F.col(_LABEL), margins, number)[k]
        grower = RandomForestRegressor(
            labelCol=_TARGET,
            numTrees=1,
            bootstrap=False,
            maxDepth=loss.depth(number, settings.depth),
            featureSubsetStrategy=str(settings.share_of_columns),
            seed=settings.seed + number * loss.outputs + k,
        )
        columns = ["features", target.alias(_TARGET)]
        if weight is not None:
            grower = grower.setWeightCol(_WEIGHT)
            columns.append(weight.alias(_WEIGHT))
        return grower.fit(rows.select(*columns)).trees[0]

    if loss.outputs == 1:
        return [fit(0)]
    with ThreadPoolExecutor(loss.outputs) as pool:
        return list(pool.map(fit, range(loss.outputs)))


def boost(rows: DataFrame, label: str, loss, settings: BoostSettings, start: Boosted | None = None) -> Boosted:
    """Boost on ``rows`` (keys, ``features``, ``label``, ``__held_out``) until ``rounds`` are there or ``patience`` rounds did not
    lower the loss of the held-out rows.

    With ``start`` the rounds after its last one are fitted. A round depends on the seed, its number and the rows only, so going on
    from a state gives the trees that an uninterrupted run would have given.
    """
    state = Boosted(settings.patience, list(start.rounds), list(start.weights), list(start.losses)) if start else Boosted(settings.patience)
    margins = [F.col(_margin(k)) for k in range(loss.outputs)]
    with stored_meanwhile(rows.select(*KEYS, "features", F.col(label).alias(_LABEL), HELD_OUT), "boosting") as table:
        few = table.where(~F.col(HELD_OUT)).limit(_FEW).count() < _FEW
        judged = not table.where(HELD_OUT).isEmpty()
        unmoved = table.select("*", *[F.lit(0.0).alias(_margin(k)) for k in range(loss.outputs)])
        while len(state.rounds) < settings.rounds and not state.ended:
            first = len(state.rounds)
            kept = _grown(unmoved, state, 0, loss.outputs).persist()
            try:
                now = kept
                while len(state.rounds) < min(first + settings.stored_every, settings.rounds) and not state.ended:
                    number = len(state.rounds)
                    state.rounds.append(_round(now.where(~F.col(HELD_OUT)), loss, settings, number, few))
                    state.weights.append(loss.weight(number, settings.step))
                    now = _grown(kept, state, first, loss.outputs)
                    if judged:
                        mean = now.where(HELD_OUT).agg(F.avg(loss.loss(F.col(_LABEL), margins)).alias("loss"))
                        state.losses.append(float(mean.collect()[0]["loss"]))
            finally:
                kept.unpersist()
    return state


class SoftmaxModel:
    """Boosted margins of the classes; the greatest one is predicted, the lesser class of equals."""

    def __init__(self, models: list[GBTRegressionModel], losses: list[float] | None = None) -> None:
        self.models, self.losses = models, list(losses or [])

    def transform(self, rows: DataFrame) -> DataFrame:
        """``rows`` with ``probability``, an array by class, and ``prediction``."""
        columns = rows.columns
        for k, model in enumerate(self.models):
            rows = model.transform(rows, {model.predictionCol: _margin(k)})
        loss, margins = SoftmaxLoss(len(self.models)), [F.col(_margin(k)) for k in range(len(self.models))]
        greatest = F.greatest(*margins) if len(margins) > 1 else margins[0]
        first = F.array_position(F.array(*margins), greatest) - 1
        chances = F.array(*[loss.probability(margins, k) for k in range(len(margins))])
        return rows.select(*columns, chances.alias("probability"), first.cast("double").alias("prediction"))

    def save(self, directory: str) -> None:
        for k, model in enumerate(self.models):
            model.write().overwrite().save(f"{directory}/class_{k}")

    @classmethod
    def load(cls, directory: str, classes: int) -> SoftmaxModel:
        return cls([GBTRegressionModel.load(f"{directory}/class_{k}") for k in range(classes)])


def loss_table(spark: SparkSession, losses: list[float]) -> DataFrame:
    """``(round, loss)``, rounds from 1."""
    return spark.createDataFrame([(i + 1, float(x)) for i, x in enumerate(losses)], "round int, loss double")
