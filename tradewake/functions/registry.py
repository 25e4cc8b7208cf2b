"""SQL names for the table functions, so queries can call them in LATERAL joins (H1-H3)."""

from __future__ import annotations

from pyspark.sql import SparkSession

from tradewake.constants import KEYWORD_CART, KEYWORD_CLICK, KEYWORD_ORDER


def register_functions(spark: SparkSession) -> None:
    """Register ``ik_analyze`` and ``keywordProductC2R`` as temporary SQL table functions.

    Both are SQL bodies: the optimizer inlines them, no Python runs per row.
    """
    spark.sql(r"""
        CREATE OR REPLACE TEMPORARY FUNCTION ik_analyze(txt STRING)
        RETURNS TABLE(word STRING)
        RETURN SELECT explode(regexp_extract_all(lower(txt), '[\\p{L}\\p{N}]+', 0))
    """)
    spark.sql(f"""
        CREATE OR REPLACE TEMPORARY FUNCTION keywordProductC2R(
            click_ct BIGINT, cart_ct BIGINT, order_ct BIGINT)
        RETURNS TABLE(ct BIGINT, source STRING)
        RETURN SELECT r.ct, r.source FROM (
            SELECT explode(filter(array(
                named_struct('ct', click_ct, 'source', '{KEYWORD_CLICK}'),
                named_struct('ct', cart_ct, 'source', '{KEYWORD_CART}'),
                named_struct('ct', order_ct, 'source', '{KEYWORD_ORDER}')), x -> x.ct > 0)) AS r)
    """)
