from __future__ import annotations

import re
import textwrap

import edge
import oracle

from crestline.llm import licenses

SF_DIR = "/root/testdata/sf0.001"


def brute(text: str | None, t: float = licenses.THRESHOLD) -> tuple:
    body = text or ""
    units = {body, *body.split("\n"), *re.sub(r"([.!?])[ \t\r\n]+", "\\1\n", body).split("\n")}
    hits = []
    for u in units:
        a = set(licenses.bigrams(u))
        scored = [(-2 * len(a & set(licenses.bigrams(x))) / (len(a) + len(licenses.bigrams(x))), n, name)
                  for n, (name, x) in enumerate(licenses.TEMPLATES.items())] if a else []
        if scored and min(scored)[0] <= -t:
            hits.append(min(scored))
    words, near = licenses.words_of(body), []
    for n, start, size in {
        (n, max(i - o, 0), size) for i, w in enumerate(words) for n, o, size in licenses.anchors().get(w, [])
    }:
        name, template = list(licenses.TEMPLATES.items())[n]
        a, b = set(licenses.bigrams(" ".join(words[start : start + size]))), set(licenses.bigrams(template))
        if 2 * len(a & b) >= t * (len(a) + len(b)):
            near.append((-2 * len(a & b) / (len(a) + len(b)), n, name))
    both = hits + near
    return len(hits), len(near), ",".join(sorted({h[2] for h in both})), round(-min(both)[0], 6) if both else None


def test_equals_brute_force(spark):
    t = licenses.TEMPLATES
    texts = [
        "Some prose.\nLicensed under CC BY-NC 4.0.\nMore prose", "RELEASED under the\tMIT license", t["mit-text"], t["gpl-3.0-header"],
        t["apache-2.0-header"].replace("governing", "ruling"), "x. Licensed under the Apache License, Version 2.0. Next sentence follows here",
        "Licensed under the MIT", "licensed", "under the", "We licensed under protest the new general public", "", None,
        "This work is licensed under the GNU General Public License, version 3.\r\n" * 3,
        t["bsd-3-clause"] + " " + edge.prose(1, 20_000), edge.prose(2, 500),
    ]
    docs = spark.createDataFrame([(i, x, "clash") for i, x in enumerate(texts)], "doc_id long, text string, units string")
    got = {r.key: tuple(r)[1:] for r in licenses.scan(docs).collect()}
    assert [got[i] for i in range(len(texts))] == [brute(x) for x in texts]


def test_notices_wrapped_inside_a_file(spark):
    """As plain text and as comments, between other text, changed in a word: in no line or sentence."""
    rows = []
    for name in ("gpl-3.0-header", "mit-text", "apache-2.0-header", "mit-license", "bsd-2-clause", "isc-license"):
        lines = textwrap.wrap(licenses.TEMPLATES[name].replace("software", "program", 1), 72)
        for mark in ("", "# ", " * "):
            body = "\n".join([edge.prose(1, 40), *[mark + x for x in lines], edge.prose(2, 60)])
            rows.append((f"{name}{mark}", name, body))
    docs = spark.createDataFrame(rows, "doc_id string, name string, text string")
    got = {r.key: r for r in licenses.scan(docs).collect()}
    assert all(n in got[k].licenses.split(",") and got[k].n_windows and got[k].best_dice > 0.8 for k, n, _ in rows)
    assert all(tuple(got[k])[1:] == brute(x) for k, _, x in rows)


def test_each_template_finds_itself(spark):
    docs = spark.createDataFrame(list(licenses.TEMPLATES.items()), "doc_id string, text string")
    assert all(r.key in r.licenses.split(",") and r.best_dice == 1 for r in licenses.scan(docs).collect())


def test_edges_and_plan(spark):
    got = licenses.scan(edge.docs(spark))
    assert got.count() == len(edge.rows()) and licenses.scan(edge.empty(spark)).count() == 0
    plan = licenses.scan(spark.read.parquet(f"{SF_DIR}/documents.parquet"))._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas|Exchange|Join", plan)


def test_query_equals_sql(spark):
    got = oracle.spark_result(licenses.op8_license_scan(spark, SF_DIR))
    assert got == oracle.duckdb_result(oracle.connect(SF_DIR), licenses.LICENSES_SQL)
