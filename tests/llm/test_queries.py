"""The registered queries with SQL against DuckDB; the pipeline against its parts."""

import hashlib
import os
import sys

import corpus_pipeline
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
from oracle_check import compare, duck  # noqa: E402

from tillroll.llm import bpe, mixing, quality, simhash, toxicity  # noqa: E402
from tillroll.llm.common import table  # noqa: E402
from tillroll.llm.oracle import ORACLE_SQL  # noqa: E402
from tillroll.llm.queries import QUERIES  # noqa: E402


@pytest.mark.parametrize("name", ORACLE_SQL)
def test_oracle(spark, sf_small, name):
    ok, _, _, detail = compare(spark, duck(sf_small), name, QUERIES[name], ORACLE_SQL[name], sf_small)
    assert ok, detail


def test_pipeline_against_its_decisions(spark, sf_small):
    """Ids, texts, digests and order of the whole pipeline, each stage done again beside it."""
    from tokenizers import Tokenizer

    docs = table(spark, sf_small, "documents")
    kept = {r.doc_id for r in quality.quality_rules(docs).where("kept").collect()}
    texts = {r.doc_id: r.clean_text for r in quality.cleaned(docs).collect()}
    cleaned = spark.createDataFrame([(r.doc_id, texts[r.doc_id], r.lang, r.source, r.n_chars)
                                     for r in docs.collect() if r.doc_id in kept], docs.schema)
    model = toxicity.train(cleaned, table(spark, sf_small, "labels"))
    clean = [r for r in cleaned.collect() if model.score(r.text or "") < 0.5]
    fps = [simhash.fingerprint((r.text or "").encode()) for r in clean]
    first = list(range(len(clean)))
    changed = True
    while changed:
        changed = False
        for i, a in enumerate(fps):
            for j, b in enumerate(fps):
                if (a ^ b).bit_count() <= 4 and first[j] < first[i]:
                    first[i], changed = first[j], True
    groups = {}
    for r, f in zip(clean, first):
        groups.setdefault(f, []).append(r.doc_id)
    left = {min(g) for g in groups.values()}
    result = corpus_pipeline.run(spark, sf_small)
    assert result.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "mix_file", "mix_row"]
    rows = sorted(result.collect(), key=lambda r: (r.mix_file, r.mix_row))
    assert {r.doc_id for r in rows} == left and len(rows) == len(left)
    library = Tokenizer.from_file(bpe.vocabulary_path())
    for r in rows:
        ids = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()
    mixed = mixing.mix(cleaned.where(cleaned.doc_id.isin(sorted(left)))).orderBy("mix_slot", "mix_place").collect()
    assert [r.doc_id for r in rows] == [r.doc_id for r in mixed]


def boilerplate_docs(spark):
    """Hosts with lines in many documents: some documents lose lines, some nearly all their words."""
    own = str.maketrans("0123456789", "abcdefghij")  # digits are one in a line's normal form
    prose = lambda i, k: " ".join(f"w{i}x{j}".translate(own) for j in range(k))
    menu = "Home  News\tAbout 12 contact us and many other words that repeat on each page of it"
    more = [" ".join(f"{w}{k}" for w in menu.split()) for k in "xyz"]
    rows = []
    for i in range(120):
        lines = [prose(i, 60), prose(i + 1000, 5)]
        if i % 3 == 0:  # 40 documents of host a, in other spacing, case and digits
            lines.insert(1, menu.upper().replace("12", str(i % 10) + "7") + " ")
        if i % 4 == 0:
            lines.insert(0, "")
        rows.append((i, "\n".join(lines), None, "a" if i < 100 else None, 1))
    for i in range(200, 230):  # mostly the menu
        rows.append((i, "\n".join([menu, *more, prose(i, 20)]), None, "a", 1))
    rows += [(300 + i, "\n".join([menu] * 8), None, "b", 1) for i in range(25)]  # copies: one document
    rows += [(400, None, None, "a", 1), (401, "", None, "a", 1), (402, " \n\t\n", None, None, 1), rows[0], rows[110]]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")


def test_quality_rules_where_they_bite(spark):
    import duckdb

    from tillroll.llm.oracle import QUALITY_CTES
    docs = boilerplate_docs(spark)
    con = duckdb.connect()
    con.register("documents", docs.toArrow())
    want = con.execute(ORACLE_SQL["op7_quality_rules"])
    names = [d[0] for d in want.description]
    got = [tuple(r) for r in quality.quality_rules(docs).select(*names).collect()]
    assert sorted(got, key=str) == sorted(want.fetchall(), key=str)
    verdicts = {r[0]: dict(zip(names, r)) for r in got}
    depleted = {i for i, v in verdicts.items() if not v["base_failed"] and not v["kept"]}
    assert depleted == set(range(200, 230))  # of host b every document is a copy: nothing is common there
    texts = con.execute(f"WITH {QUALITY_CTES.replace('{docs}', 'documents')} SELECT doc_id, t, clean_text "
                        "FROM doc LEFT JOIN gone USING (r)").fetchall()
    changed = {i for i, t, c in texts if c is not None and t != c}
    assert len(changed) == 34 + 30
    rebuilt = {r.doc_id: r.clean_text for r in quality.cleaned(docs).collect()}
    assert all(rebuilt[i] == (t if c is None else c) for i, t, c in texts if i != 400) and rebuilt[400] is None
    kept = {r.doc_id: r.text for r in quality.keep_good(docs).collect()}
    assert set(kept) == {i for i, v in verdicts.items() if v["kept"]}
    assert all(kept[i] == rebuilt[i] for i in kept)


def test_cleaned_with_a_column_of_its_own_names(spark):
    docs = boilerplate_docs(spark).selectExpr("*", "1 AS gone", "'x' AS row", "2 AS clean_text", "3 AS host")
    got = quality.cleaned(docs)
    assert got.columns == [*(c for c in docs.columns if c != "clean_text"), "clean_text"]
    assert {r.gone for r in got.collect()} == {1}
