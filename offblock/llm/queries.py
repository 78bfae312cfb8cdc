"""The registered queries of this package: each applies its operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from offblock.llm import bpe, ego_join, jaccard, k2_treap, language_id, lattice_lm, line_dedup, packing, prefix_trie, quality_rules, simhash, tool_calls, url_filter
from offblock.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def _on(name: str, operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: operator(table(spark, sf_dir, name))


def queries() -> dict[str, Query]:
    import corpus_pipeline

    return {
        "op1_simhash": _on("documents", simhash.op1_simhash),
        "op2_url_filter": _on("pages", url_filter.op2_url_filter),
        "op3_language_id": _on("documents", language_id.op3_language_id),
        "op4_tool_calls": _on("conversations", tool_calls.op4_tool_calls),
        "op5_ego_join": _on("embeddings", ego_join.cosine_components),
        "op6_jaccard": _on("documents", jaccard.jaccard_components),
        "op7_line_dedup": _on("documents", line_dedup.line_report),
        "op8_lattice_lm": _on("documents", lattice_lm.op8_lattice_lm),
        "op9_bpe": _on("documents", bpe.op9_bpe),
        "op10_packing": _on("documents", packing.pack_documents),
        "op11_k2_treap": lambda spark, sf_dir: k2_treap.ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")),
        "op12_prefix_trie": _on("conversations", prefix_trie.prefix_trie),
        "op13_quality_rules": lambda spark, sf_dir: quality_rules.op13_quality_rules(
            table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")),
        "pipeline": corpus_pipeline.run,
    }


def oracle_sql() -> dict[str, str]:
    return {"op2_url_filter": url_filter.OP2_SQL, "op11_k2_treap": k2_treap.OP11_SQL,
            "op12_prefix_trie": prefix_trie.OP12_SQL}
