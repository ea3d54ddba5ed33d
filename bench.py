"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR is the table folder, BENCH_CPUS the number of local cores.
"""

import json
import os
import time

from pyspark.sql import SparkSession

from tonegauge import plans

HEADLINES = [
    "p2_dedupe_text", "p8_balanced_weights", "p18_clean_audit", "c1_stratified_split", "c5_sample_n",
    "t3_lemmas", "t7_tf_idf", "t11_top_words", "a1_overall_stats", "a3_monthly_sentiment", "a4_live_trend",
    "a6_product_scoring", "a8_top_products_sentiment", "a9_score_all_products", "a10_recent", "a11a_drift",
    "e1_profile", "e3_duplicates", "e12_word_histogram", "e13_box_stats", "e17_user_activity",
    "m7b_threshold_scores", "m8_metrics", "m12_auc", "r7_delivery_check",
]


def main():
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = plans.queries()
    # the first query pays for starting the engine
    queries["a16_total_predictions"](spark, folder).collect()
    seconds = {}
    for name in HEADLINES:
        start = time.perf_counter()
        # every column is computed and nothing is sent to the driver
        queries[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({
        "metric": "headline queries", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
