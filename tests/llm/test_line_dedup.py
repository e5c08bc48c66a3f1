"""The template tree against a plain version of it."""

import random
import re
from collections import Counter, defaultdict

import pytest

from civicframe.llm import line_dedup
from tests.llm.fixtures import awkward, empty, rows_of


def tokens_of(line):
    return tuple("<*>" if re.search("[0-9]", t) else t for t in re.findall(r"[^\x20\x09-\x0D]+", line))


def fields(tokens):
    many = min(len(tokens), 8)
    cuts = [j * len(tokens) // many for j in range(many + 1)]
    return {j: tokens[cuts[j]:cuts[j + 1]] for j in range(many) if cuts[j + 1] > 3}


def brute(rows):
    placed = [(key, text, i, tokens_of(line)) for key, text in rows if text is not None for i, line in enumerate(text.split("\n")) if tokens_of(line)]
    leaves = defaultdict(set)
    for *_, t in placed:
        leaves[len(t), t[:3]].add(t)
    template = {}
    for leaf, lines in leaves.items():
        votes = Counter((j, v) for t in lines for j, v in fields(t).items())
        constant = {c for c, n in votes.items() if n > 1 and 2 * n > len(lines)}
        for t in lines:
            same = sum(c in constant for c in fields(t).items())
            template[t] = ("leaf", leaf) if len(lines) > 1 and 2 * same >= len(fields(t)) else ("exact", t)
    documents, first = defaultdict(set), {}
    for key, text, i, t in placed:
        documents[template[t]].add((key, text))
    order = lambda p: (p[0] is None, p[0] or 0, p[2])
    for p in sorted(placed, key=order):
        first.setdefault(template[p[3]], p[:3])
    gone = {p[:3] for p in placed if len(documents[template[p[3]]]) > 1 and first[template[p[3]]] != p[:3]}
    out = []
    for key, text in rows:
        lines = [] if text is None else text.split("\n")
        kept = [x for i, x in enumerate(lines) if (key, text, i) not in gone]
        out.append((key, len(lines), len(lines) - len(kept), None if text is None else "\n".join(kept)))
    return sorted(out, key=str)


def log_texts():
    rng = random.Random(8)
    users = ["ann", "bob", "cid", "dora", "eve"]
    made = []
    for i in range(60):
        lines = [f"user {rng.choice(users)} logged in from 10.0.{i}.{rng.randrange(9)} at port {rng.randrange(9000)}",
                 f"cache for shard {rng.choice(users)} was rebuilt in {rng.randrange(99)} ms without any error at all",
                 " ".join(rng.choice("abcdefghij") * 3 for _ in range(rng.randrange(1, 30))), "All rights reserved.", "", "the end of it"]
        rng.shuffle(lines)
        made.append("\n".join(lines[: rng.randrange(1, 7)]))
    return made + made[:5]


def test_against_the_plain_tree(spark):
    docs = awkward(spark, log_texts(), extra=True)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect() if r["doc_id"] is not None]
    rows = [r for r in rows if r[0] != 7]  # two texts under one id: their order is by hash
    docs = docs.where("doc_id is not null and doc_id <> 7")
    got = line_dedup.drop_recurring_lines(docs)
    assert got.columns == ["doc_id", "n_lines", "n_dropped", "text"]
    assert rows_of(got) == brute(rows)


def test_variable_fields_and_first_line(spark):
    docs = spark.createDataFrame([(1, "job alpha took long time on host red today\nkeep me here"), (2, "job alpha took long time on host blue today"),
                                  (3, "job alpha took long time on host green today\nanother line")], "doc_id bigint, text string")
    assert rows_of(line_dedup.drop_recurring_lines(docs)) == [
        (1, 2, 0, "job alpha took long time on host red today\nkeep me here"), (2, 1, 1, ""), (3, 2, 1, "another line")]


@pytest.mark.parametrize("extra", [False, True])
def test_documents_keep_their_columns(spark, extra):
    docs = awkward(spark, log_texts(), extra)
    clean = line_dedup.clean_documents(docs)
    assert clean.columns == docs.columns and clean.dtypes == docs.dtypes
    assert clean.count() == docs.count()
    assert sorted((r["doc_id"], r["text"]) for r in clean.collect() if r["doc_id"] == 6) == [
        (r["doc_id"], r["text"]) for r in docs.collect() if r["doc_id"] == 6]
    changed = [r for r in clean.collect() if r["text"] is not None and r["doc_id"] is not None and r["doc_id"] >= 100]
    assert all(r["n_chars"] == len(r["text"]) for r in changed)


def test_empty_table(spark):
    assert rows_of(line_dedup.drop_recurring_lines(empty(spark))) == []
    assert line_dedup.clean_documents(empty(spark)).columns == ["doc_id", "text", "lang", "source", "n_chars"]


def test_only_dataframe_functions(spark):
    plan = line_dedup.drop_recurring_lines(awkward(spark))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
