"""Print the physical plan of registered queries: python tools/explain.py [SF_DIR] name-substring [mode]"""
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from fieldlens.registry import QUERIES  # noqa: E402
from fieldlens.session import get_session  # noqa: E402

args = sys.argv[1:]
sf_dir = args.pop(0) if args and args[0].startswith("/") else "/root/testdata/sf0.1"
pat = args[0]
mode = args[1] if len(args) > 1 else "formatted"
spark = get_session("local[8]", shuffle_partitions=8)
for name, (fn, _) in QUERIES.items():
    if pat in name:
        print("=" * 20, name)
        df = fn(spark, sf_dir)
        if mode == "final":
            df.collect()  # same QueryExecution: explain then shows the final adaptive plan
            df.explain()
        else:
            df.explain(mode)
