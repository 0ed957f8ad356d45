"""Write PLANS.md: the physical plan of the main operators (before execution).

Usage: python tools/dump_plans.py [sf_dir]
"""
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from souk.operators import report, stats  # noqa: E402
from souk.operators.labels import thresholds  # noqa: E402
from souk.plans import stages as P  # noqa: E402
from souk.plans.ingest import ingest  # noqa: E402
from souk.functions.text import WHITESPACE  # noqa: E402
from souk.session import get_session  # noqa: E402
from souk.sources.categories import category_dim  # noqa: E402
from souk.sources.fixture import landing_from_tables  # noqa: E402

NOTES = {
    "clean_listings": "scan (pruned, filters pushed) -> exchange that deals out the stand-in input (the test file is one row "
                      "group) -> broadcast joins to part/supplier -> parsing projections -> partial min_by "
                      "(sort aggregate) -> one hash exchange on the link -> final min_by.",
    "thresholds (after the hand-off)": "distinct-value counts with partial aggregation; the range "
                      "layout is checkpointed inside the operator, so the plan below starts from that checkpoint.",
    "label_products": "a pruned scan of the handed-off featured table, joined to the one row of thresholds.",
    "top_products_rows": "partial WindowGroupLimit before the exchange: at most 3 rows per label per task move.",
    "price_by_label": "starts from the counts of distinct values per label (the rows are read once, before); quartiles joined null-safely.",
    "ingest_tiki": "items as raw JSON texts, posexplode, from_json of each, projection, broadcast join to the 44-row "
                   "dimension; no exchange after the landing table.",
}


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_session("local[8]")
    feat = P.featured(spark, sf)
    lab = P.labeled(spark, sf)
    sold = lab.withColumn("sold", F.col("quantity_sold_value"))
    landing = landing_from_tables(spark, sf).checkpoint(eager=True)
    plans = {
        "clean_listings": P.cleaned(spark, sf),
        "thresholds (after the hand-off)": thresholds(feat),
        "label_products": lab,
        "top_products_rows": report.top_k_per_group(sold, "label", [F.desc_nulls_last("sold"), F.asc("product_url")], 3),
        "price_by_label": stats.box_stats(lab, "label", "current_price"),
        "ingest_tiki": ingest(landing, category_dim(spark))["tiki"],
    }
    out = ["# Physical plans", "",
           f"Generated by `python tools/dump_plans.py {sf}` (plans before execution; AQE may still",
           "turn shuffle joins into broadcast joins and coalesce partitions at run time).",
           "`<ws>` stands for the white space trimmed by `strip_ws`.", ""]
    for name, df in plans.items():
        tree = df._jdf.queryExecution().executedPlan().treeString().replace(WHITESPACE, "<ws>")
        out += [f"## {name}", "", NOTES.get(name, ""), "", "```", tree.rstrip(), "```", ""]
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as f:
        f.write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main()
