"""The registered queries of this package and the SQL that must agree with them."""

from __future__ import annotations

import functools
import tempfile
import zipfile
from pathlib import Path

from forgemart.llm import (
    contamination,
    exact_dedup,
    html,
    katz,
    minhash,
    mixing,
    packing,
    quality,
    ranking,
    substrings,
    topk,
    toxicity,
    whitening,
)
from forgemart.llm.common import table

_shipped: set[str] = set()


def ship(spark) -> None:
    """Give the executors' Python workers this package, once per application."""
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        top = Path(__file__).resolve().parents[1]
        archive = Path(tempfile.mkdtemp(prefix="forgemart-code-")) / f"{top.name}.zip"
        with zipfile.ZipFile(archive, "w") as out:
            for path in sorted(top.rglob("*.py")):
                out.write(path, path.relative_to(top.parent))
        spark.sparkContext.addPyFile(str(archive))
        _shipped.add(app)


def shipped(query):
    """``query`` with the package at hand on the executors."""

    @functools.wraps(query)
    def run(spark, sf_dir):
        ship(spark)
        return query(spark, sf_dir)

    return run


def op1_exact_dedup(spark, sf_dir):
    return exact_dedup.copies(table(spark, sf_dir, "documents"))


def op2_packing(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"))


def op3_quality(spark, sf_dir):
    return quality.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_minhash(spark, sf_dir):
    return minhash.classes(table(spark, sf_dir, "documents"))


def op5_katz(spark, sf_dir):
    return katz.score(table(spark, sf_dir, "documents"))


def op6_topk(spark, sf_dir):
    return topk.search(table(spark, sf_dir, "embeddings"))


def op7_html(spark, sf_dir):
    return html.extract(table(spark, sf_dir, "pages"))


def op8_substrings(spark, sf_dir):
    return substrings.remove_repeats(table(spark, sf_dir, "documents"))


def op9_mixing(spark, sf_dir):
    return mixing.schedule(table(spark, sf_dir, "documents"))


def op10_toxicity(spark, sf_dir):
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_contamination(spark, sf_dir):
    return contamination.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_ranking(spark, sf_dir):
    return ranking.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_whitening(spark, sf_dir):
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


_ALL = (
    op1_exact_dedup,
    op2_packing,
    op3_quality,
    op4_minhash,
    op5_katz,
    op6_topk,
    op7_html,
    op8_substrings,
    op9_mixing,
    op10_toxicity,
    op11_contamination,
    op12_ranking,
    op13_whitening,
)
QUERIES = {f.__name__: shipped(f) for f in _ALL}
ORACLES = {
    "op1_exact_dedup": exact_dedup.ORACLE_SQL,
    "op6_topk": topk.ORACLE_SQL,
    "op11_contamination": contamination.ORACLE_SQL,
    "op12_ranking": ranking.ORACLE_SQL,
}
