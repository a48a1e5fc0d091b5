"""Quality rules against their SQL and a plain loop."""

import re
from collections import defaultdict

from tidemark.llm import quality
from tidemark.llm.queries import QUERIES, SQL

DOCS = "doc_id long, text string, n_words string, kept int"


def brute(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    at = defaultdict(list)
    for i in range(len(words) - 2):
        at[tuple(words[i:i + 3])].append(i)
    covered = {i + k for places in at.values() if len(places) > 1 for i in places for k in range(3)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered), failed


def test_documents_match_sql(spark):
    from oracle import compare, duck
    name, folder = "op8_quality_rules", "/root/testdata/sf0.01"
    assert compare(spark, duck(folder), folder, QUERIES[name], SQL[name]) is None


def test_odd_texts(spark):
    good = "the cat sat on a mat and looked at the moon while " * 1
    long = " ".join(f"w{i} the" for i in range(40))
    texts = [None, "", " \n\t\r\x0b\x0c ", "a", "a b", "a b c", "a b c a b c", "a a a", "a a a a a", "x\ny\nx\nx\n \n\n", "é ü ß　x", good, good * 3, long, long + "\n" + long,
             long + " $$$ %%", long + "!" * 50, "# * $ % & | < >", "\r\nline\r\nline\n", "💡 " * 60, " ".join("ABCDE"[i % 5] for i in range(400)), "w " * 200000]
    docs = spark.createDataFrame([(i, t, "clash", 7) for i, t in enumerate(texts)], DOCS)
    got = {r.doc_id: r for r in quality.quality_rules(docs).collect()}
    for i, t in enumerate(texts):
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute(t), (i, t and t[:40])
        assert not (r.base_failed and r.kept)
    assert got[13].kept and not got[14].kept and got[15].kept and not got[16].kept
    assert quality.quality_rules(docs.union(docs)).count() == 2 * len(texts)
    assert quality.quality_rules(docs.limit(0)).count() == 0


def test_one_projection_without_user_functions(spark):
    plan = quality.quality_rules(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan
