"""Write the final (after AQE) physical plans of the core operators and jobs
to docs/plans.md, run on the driver tables at sf 0.01.

Usage: python tools/dump_plans.py [sf_dir]
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from pyspark.sql import functions as F  # noqa: E402

from reelstack import operators as op  # noqa: E402
from reelstack.params import CatalogParams  # noqa: E402
from reelstack.plans import acceptance as acc  # noqa: E402
from reelstack.plans.jobs import trusted_api, trusted_catalog  # noqa: E402
from reelstack.plans.star import GENERAL, build_star, joined_base  # noqa: E402
from reelstack.session import build_session  # noqa: E402
from reelstack.sources import flatten_pages  # noqa: E402


def final_plan(df) -> str:
    df.collect()  # run it, so the adaptive plan is final
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    text = re.sub(r"#\d+L?", "", buf.getvalue())
    return "\n".join(line[:220] for line in text.splitlines())


def scenarios(spark, d):
    t = lambda name: acc.table(spark, d, name)
    yield ("keep_first: row_number() = 1 per key",
           op.keep_first(t("events").select("user_id", "event_id", "event_type"), "user_id",
                         ["event_id"]))
    yield ("dense_key_scaled: distributed surrogate key",
           op.dense_key_scaled(t("orders").select("o_orderkey"), "o_orderkey", "k", "tig"))
    movies, api = acc._star_inputs(spark, d)
    base = joined_base(movies, api)
    yield ("star base: per-side dedup, then join on the id", base)
    tables = build_star(base, GENERAL, measures=["orcamento"])
    yield ("star fact: projection of the numbered base + year key",
           tables[GENERAL.fact])
    yield ("star title dimension", tables[GENERAL.title_dim])
    pages = acc._event_pages(spark, d)
    yield ("flatten_pages on landed pages", flatten_pages(pages, "genre"))
    params = CatalogParams(saga_keywords=["red ring", "small gizmo"], deny_ids=[1, 2, 3],
                           genre_keywords=["URGENT", "HIGH"], year_first=1996, year_last=1999,
                           min_minutes=80, min_votes=30000)
    yield ("trusted catalogue: one filter, one dedup",
           trusted_catalog(acc._catalog_rows(spark, d), params))
    yield ("trusted API: gates, global sort", trusted_api(acc._api_raw(spark, d)))
    yield ("id allow-list pushed into both scans",
           op.keep_ids(base, "imdb_id", acc.SUBSET_ORDER_IDS))
    yield ("union of keyword branches in one scan",
           acc.q_union_branches(spark, d))
    yield ("left join with pre-aggregated details", acc.q_join_left_details(spark, d))
    yield ("fan-out size without pairs", acc.q_fact_date_fanout(spark, d))


def main(argv):
    d = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", 8)
    out = [f"# Physical plans\n\nFinal adaptive plans at `{os.path.basename(d)}` on local[8], "
           "written by `tools/dump_plans.py` (expression ids removed, long lines cut).\n"]
    for title, df in scenarios(spark, d):
        out.append(f"## {title}\n\n```\n{final_plan(df)}\n```\n")
    with open(os.path.join(ROOT, "docs", "plans.md"), "w") as fh:
        fh.write("\n".join(out))
    print("wrote docs/plans.md")


if __name__ == "__main__":
    main(sys.argv)
