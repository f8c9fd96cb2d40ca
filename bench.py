"""Time the headline queries; prints one JSON line.

Environment: BENCH_SF_DIR (default sf0.1), BENCH_CPUS (local cores).
``build_*`` entries are the stored tables that the later queries read; every
entry is timed once, in order, on a fresh session.
"""

import contextlib
import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from readgrade.session import session  # noqa: E402

HEADLINES = [
    "m5_ari", "m11_surface_features", "t1_blank_guard", "t7_noun_chunks", "s4_word_frequency", "m12_variety",
    "m9_metrics_profile", "m9_metrics_model", "m4_avrfreqrank", "l8_flat_lookup", "l12_lexical_profile",
    "p2_level_profiles", "p6_distance", "p7_advice", "q10_parse_answers", "q12_two_questions", "q13_evaluate",
    "q17_best_attempts", "r3_by_level_counts", "ml7_split", "k1_texts_csv", "k2_metrics_csv",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    with contextlib.redirect_stdout(sys.stderr):
        from catalog import QUERIES
        from catalog.data import data

        spark = session("bench", os.environ.get("BENCH_CPUS"))
        tables, times = data(spark, folder), {}

        def timed(name, action):
            start = time.perf_counter()
            action()
            times[name] = round(time.perf_counter() - start, 3)
            print(name, times[name], flush=True)

        timed("build_forms", lambda: tables.forms)
        timed("build_lexicon", lambda: tables.lexicon)
        timed("build_counts", lambda: tables.counts)
        timed("build_measured", lambda: tables.measured)
        timed("build_features", lambda: tables.stored_features)
        for name in HEADLINES:
            timed(name, lambda: QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save())
    print(json.dumps({"metric": "total_wall_time", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf")}))


if __name__ == "__main__":
    main()
