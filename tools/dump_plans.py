"""Write the executed (AQE final) physical plans of the bench's headline queries to docs/PLANS.md.

usage: python tools/dump_plans.py [sf_dir]
"""
import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from bench import HEADLINE  # noqa: E402
from webstats.plans.registry import all_queries  # noqa: E402
from webstats.session import build_session  # noqa: E402
from webstats.sources.adapters import Tables  # noqa: E402

KEEP = re.compile(r"(Exchange|Join|Aggregate|Scan|Window|TakeOrdered|Subquery|Expand|MapInPandas|FlatMapGroups|"
                  r"Union|Generate|AQEShuffleRead|Sort \[|Filter)")


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session("local[8]", shuffle_partitions=8)
    t = Tables(spark, sf)
    qs = all_queries()
    out = ["# Physical plans of the headline queries", "",
           f"Final adaptive plans after one execution at `{os.path.basename(sf)}`, local[8], shuffle partitions 8. "
           "Operator lines only; long attribute lists are elided. Generated by `tools/dump_plans.py`.", ""]
    for k in HEADLINE:
        df = qs[k](t)
        df.write.format("noop").mode("overwrite").save()
        plan = df._jdf.queryExecution().executedPlan().toString()
        shuffles = len(re.findall(r"Exchange (hashpartitioning|SinglePartition|rangepartitioning|RoundRobin)", plan))
        bcast = plan.count("BroadcastExchange")
        out += [f"## {k}", "", f"shuffle exchanges: {shuffles}, broadcast exchanges: {bcast}", "", "```"]
        for line in plan.split("\n"):
            if KEEP.search(line):
                line = re.sub(r"\[[^\[\]]{50,}\]", "[...]", line)
                line = re.sub(r"Location: InMemoryFileIndex\([^)]*\)\[[^\]]*\]", "Location: ...", line)
                out.append(line[:160])
        out += ["```", ""]
    with open(os.path.join(ROOT, "docs", "PLANS.md"), "w") as f:
        f.write("\n".join(out) + "\n")
    spark.stop()


if __name__ == "__main__":
    main()
