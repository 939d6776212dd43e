"""Write PLANS.md: the physical plan trees (``explain("formatted")``, tree part
plus scan details) of the headline queries, on stored sf0.01 inputs.

    python tools/plans.py [--sf /root/testdata/sf0.01]
"""

from __future__ import annotations

import argparse
import io
import os
import re
import sys
from contextlib import redirect_stdout

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    a = ap.parse_args()
    from folio.operators import articles as A
    from folio.operators import discovery as D
    from folio.operators import index as IX
    from folio.operators import maintenance as MT
    from folio.session import build_session, scratch_path
    from folio.sources.fixtures import Fixtures
    from folio.sources.tables import ignore_set, scan_markdown, scan_pages

    spark = build_session("local[8]", shuffle_partitions=16)
    src = Fixtures(spark, a.sf)
    root = scratch_path(spark, "plans-input")
    names = ["fx_pages", "fx_meta", "fx_completed", "fx_links", "fx_ignored", "fx_aliases", "fx_queue",
             "fx_markdown"]
    for n in names:
        src[n].repartition(8).write.mode("overwrite").parquet(f"{root}/{n}")
    fx = {n: spark.read.parquet(f"{root}/{n}") for n in names}
    idx = scratch_path(spark, "plans-index")
    IX.build_article_index(scan_markdown(fx["fx_markdown"])).write.mode("overwrite").parquet(idx)
    queries = {
        "extract_articles": A.extract_articles(scan_pages(fx["fx_pages"]), fx["fx_meta"], fx["fx_completed"]),
        "discover_new_articles": D.discover_new_articles(
            D.extract_links(scan_pages(fx["fx_pages"])).unionByName(fx["fx_links"]),
            ignore_set(fx["fx_ignored"]), fx["fx_aliases"], fx["fx_queue"]),
        "query_articles": IX.query_articles(spark.read.parquet(idx), author="author 1", domain="author2.substack.com",
                                            since="2024-03-01", until="2024-12-31", title_contains="head"),
        "verify_integrity": MT.verify_integrity(scan_pages(fx["fx_pages"]), fx["fx_meta"]),
        "build_article_index": IX.build_article_index(scan_markdown(fx["fx_markdown"])),
    }
    out = ["# PLANS — physical plans of the headline queries", "",
           "Generated by `tools/plans.py` (stored sf0.01 inputs, `local[8]`, AQE on; the plans are the",
           "initial adaptive plans). The parse stage first writes the HTML pass output (see",
           "`session.materialize`), so its plan starts from that Parquet table.", ""]
    for name, df in queries.items():
        buf = io.StringIO()
        with redirect_stdout(buf):
            df.explain("formatted")
        text = buf.getvalue()
        tree = text.split("\n\n\n")[0]
        scans = re.findall(r"\(\d+\) Scan parquet.*?\n(?:.*\n)*?(?:ReadSchema: .*)", text)
        out += [f"## {name}", "", "```", tree.strip(), "```", ""]
        for s in scans:
            lines = [ln for ln in s.splitlines() if ln.startswith(("(", "PushedFilters", "ReadSchema"))]
            out += ["```", *[ln[:400] for ln in lines], "```", ""]
    open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w").write(
        "\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main()
