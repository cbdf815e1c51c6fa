"""Times the headline queries; prints one JSON line."""

import json
import os
import time

from wordspan.plans import registry
from wordspan.session import session

HEADLINES = ["word_profile_by_lang", "filtered_index_range", "prefix_source_match", "sentence_segments", "prefix_suffix_split", "three_part_split", "one_class_windows", "boundary_windows", "merged_split_counts", "subword_label_alignment", "average_precision", "model_comparison", "cooldown_strikes"]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = session(f"local[{cpus}]", int(cpus), **{"spark.ui.enabled": "false", "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    registry.QUERIES["word_profile_by_lang"](spark, folder).write.format("noop").mode("overwrite").save()
    took = {}
    for name in HEADLINES:
        began = time.time()
        registry.QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        took[name] = round(time.time() - began, 3)
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "sf": os.path.basename(folder.rstrip("/"))}))


if __name__ == "__main__":
    main()
