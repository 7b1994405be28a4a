"""Model bundles: everything a fitted model needs, on shared storage (IO-5, IO-6).

``path/content_type=<type>/data-<id>/<model>/<table>`` holds the models' tables as Parquet: vocabulary, weights, item
norms, predictions, SVD factors and basis, ridge coefficients, the forest's nodes and bins, the MLP's parameters and
scaler.  A manifest ``manifest-<number>.json`` beside them names the data folder, the models, their parameters and
scalars.  It is written last, under another name, and then renamed, so a bundle that was not finished is never read,
and readers of an earlier one are not disturbed.  There is one line of manifests per content type.
"""

from __future__ import annotations

import json
import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .combine import arrays_of, arrays_table
from .forest import FittedForest, ForestModel
from .linear import RidgeModel
from .models import MODEL_NAMES, FittedModel
from .tfidf import TfidfModel

_NODES = "tree int, node long, feature int, bin int, value double, weight double, gain double"


# ------------------------------------------------------------------ one model as tables and scalars

def _parts(spark: SparkSession, fm: FittedModel) -> tuple[dict[str, DataFrame], dict]:
    tables: dict[str, DataFrame] = {}
    told = {"params": fm.params, "fit_seconds": fm.fit_seconds, "n_items": fm.n_items,
            "extras": {k: v for k, v in fm.extras.items() if isinstance(v, (int, float, str, list))}}
    if fm.tfidf is not None:
        tables |= {"vocab": fm.tfidf.vocab, "weights": fm.tfidf.weights, "item_norms": fm.tfidf.item_norms}
        if fm.tfidf.tf is not None:
            tables["tf"] = fm.tfidf.tf
        told["tfidf"] = {"max_features": fm.tfidf.max_features, "ngram_max": fm.tfidf.ngram_max}
    if fm.predictions is not None:
        tables["predictions"] = fm.predictions
    if fm.factors is not None:
        tables["factors"] = fm.factors
    s = fm.state
    if isinstance(s, RidgeModel):
        told["state"] = {"intercept": s.intercept, "numeric": s.numeric}
        if s.terms is not None:
            tables["coefficients"] = s.terms
    elif isinstance(s, FittedForest):
        told["state"] = {"trees": s.model.trees, "features": s.model.features, "n_text": s.n_text, "numeric": s.numeric,
                         "numeric_at": s.numeric_at}
        tables["nodes"] = spark.createDataFrame(s.model.nodes, _NODES)
        if s.cuts is not None:
            tables["cuts"] = s.cuts
    elif fm.name == "svd":
        tables["basis"] = arrays_table(spark, {"basis": s})
    elif fm.name == "neural":
        theta, shapes, mu, sd, history = s
        told["state"] = {"shapes": shapes}
        tables["network"] = arrays_table(spark, {"theta": theta, "mu": mu, "sd": sd, "history": np.array(history)})
    return tables, told


def _whole(spark: SparkSession, name: str, told: dict, read) -> FittedModel:
    fm = FittedModel(name, told["params"], told["fit_seconds"], told["n_items"], extras=told["extras"])
    has = told["tables"]
    if "tfidf" in told:
        norms = read("item_norms")
        fm.tfidf = TfidfModel(read("vocab"), read("weights"), norms, norms.select(F.count(F.lit(1))).scalar(),
                              told["tfidf"]["max_features"], told["tfidf"]["ngram_max"], read("tf") if "tf" in has else None)
    fm.predictions = read("predictions") if "predictions" in has else None
    fm.factors = read("factors") if "factors" in has else None
    s = told.get("state")
    if name == "linear":
        fm.state = RidgeModel(s["intercept"], [tuple(x) for x in s["numeric"]], read("coefficients") if "coefficients" in has else None)
    elif name == "random_forest":
        nodes = [tuple(r) for r in read("nodes").collect()]
        fm.state = FittedForest(ForestModel(s["trees"], s["features"], nodes), read("cuts") if "cuts" in has else None,
                                s["n_text"], s["numeric"], s["numeric_at"])
    elif name == "svd":
        fm.state = arrays_of(read("basis"))["basis"]
    elif name == "neural":
        x = arrays_of(read("network"))
        fm.state = (x["theta"], [tuple(k) for k in s["shapes"]], x["mu"], x["sd"], x["history"].tolist())
    return fm


# ------------------------------------------------------------------ manifests

def _store(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def _manifests(spark: SparkSession, root: str) -> dict[int, str]:
    """Path of each manifest by its number."""
    fs, place = _store(spark, f"{root}/manifest-*.json")
    found = [str(x.getPath()) for x in (fs.globStatus(place) or [])]
    return {int(p.rsplit("manifest-", 1)[1].removesuffix(".json")): p for p in found}


def _publish(spark: SparkSession, root: str, manifest: dict) -> int:
    fs, draft = _store(spark, f"{root}/_draft-{manifest['data']}.json")
    out = fs.create(draft, True)
    out.write(bytearray(json.dumps(manifest).encode()))
    out.close()
    number = max(_manifests(spark, root), default=0) + 1
    while True:
        final = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/manifest-{number}.json")
        if not fs.exists(final) and fs.rename(draft, final):
            return number
        number += 1


def _root(path: str, content_type: str) -> str:
    return f"{path.rstrip('/')}/content_type={content_type}"


def save_bundle(fitted: dict[str, FittedModel], path: str, content_type: str = "all") -> int:
    """Writes the models of one content type; returns the manifest's number."""
    if not fitted:
        raise ValueError("a bundle needs at least one model")
    some = next(iter(fitted.values()))
    spark = (some.predictions if some.predictions is not None else some.tfidf.vocab).sparkSession
    root, data = _root(path, content_type), uuid.uuid4().hex
    manifest = {"data": data, "content_type": content_type, "models": {}}
    for name, fm in fitted.items():
        tables, told = _parts(spark, fm)
        for table, df in tables.items():
            df.write.parquet(f"{root}/data-{data}/{name}/{table}")
        manifest["models"][name] = told | {"tables": sorted(tables)}
    return _publish(spark, root, manifest)


def load_bundle(spark: SparkSession, path: str, names: list[str] | None = None, content_type: str = "all",
                number: int | None = None) -> dict[str, FittedModel]:
    """The models of the newest whole bundle of a content type, or of that with the given number."""
    root = _root(path, content_type)
    found = _manifests(spark, root)
    number = max(found, default=None) if number is None else number
    if number not in found:
        raise FileNotFoundError(f"no model bundle in {root}")
    manifest = json.loads(spark.read.text(found[number], wholetext=True).first()[0])
    out = {}
    for name in names or [n for n in MODEL_NAMES if n in manifest["models"]]:
        if name not in manifest["models"]:
            raise KeyError(f"the bundle has no model {name!r}")
        base = f"{root}/data-{manifest['data']}/{name}"
        out[name] = _whole(spark, name, manifest["models"][name], lambda t, base=base: spark.read.parquet(f"{base}/{t}"))
    return out
