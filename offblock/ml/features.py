"""Feature assembly.

The tree families of ``ml.histogram`` take missing values as they are
(``native``: NaN in the vector) and learn a side for them at each split. For
learners that reject them, each feature with missing values in training gets a
0/1 indicator input and a sentinel fill (below any real value); the indicator's
attribution is folded back into its feature.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offblock.operators.schema import q, split_features_label

SENTINEL = -1.0e15
VECTOR = "features"


@dataclass
class FeatureSpec:
    label: str
    features: list[str]
    inputs: list[str] = field(default_factory=list)
    source: list[str] = field(default_factory=list)
    indicators: dict[str, str] = field(default_factory=dict)
    for_trees: bool = False
    native: bool = False

    def to_json(self) -> str:
        return json.dumps(asdict(self))

    @staticmethod
    def from_json(text: str) -> FeatureSpec:
        return FeatureSpec(**json.loads(text))


def feature_spec(train: DataFrame, label: str, non_features: list[str], for_trees: bool, native: bool = False) -> FeatureSpec:
    """Learn the input list from the training set in one aggregate."""
    feats = split_features_label(train, label, non_features)
    prof = train.agg(F.count(F.lit(1)).alias("__n"), *[F.count_if(q(c).isNull()).alias(c) for c in feats]).first()
    n = prof["__n"]
    spec = FeatureSpec(label=label, features=[], for_trees=for_trees, native=native)
    for c in feats:
        missing = prof[c]
        if missing == n and n > 0:
            continue  # all missing in training: no information, not an input
        spec.features.append(c)
        spec.inputs.append(c)
        spec.source.append(c)
        if for_trees and not native and missing > 0:
            ind = f"{c}__missing"
            spec.indicators[c] = ind
            spec.inputs.append(ind)
            spec.source.append(c)
    return spec


def assemble(df: DataFrame, spec: FeatureSpec, keep: list[str] | None = None) -> DataFrame:
    """Add the ``features`` vector (inputs as double). Absent feature columns count as 0.

    Inputs go through positional temporary columns, as the assembler cannot
    address names holding dots (``No. Engines``).
    """
    values: dict[str, object] = {}
    for c in spec.features:
        x = q(c).cast("double") if c in df.columns else F.lit(0.0)
        if spec.for_trees and not spec.native:
            if c in spec.indicators:
                values[spec.indicators[c]] = x.isNull().cast("double")
            x = F.coalesce(x, F.lit(SENTINEL))
        values[c] = x
    tmp = [f"__in{i}" for i in range(len(spec.inputs))]
    prepared = df.withColumns({t: values[name] for t, name in zip(tmp, spec.inputs, strict=True)})
    va = VectorAssembler(inputCols=tmp, outputCol=VECTOR, handleInvalid="keep")
    out = va.transform(prepared).drop(*tmp)
    if keep is not None:
        extra = [c for c in spec.features if c in out.columns and c not in keep]
        out = out.select(*[q(c) for c in keep if c in out.columns], *[q(c) for c in extra], VECTOR)
    return out
