from tests.llm.conftest import EDGE_ROWS
from tiffin.llm import lines


def brute(docs, width=3):
    """docs in (id, text) order -> text left, lines, removed."""
    seen, out = set(), []
    for doc_id, text in docs:
        ls, gone = (text or "").split("\n"), set()
        for i in range(len(ls) - width + 1):
            w = tuple(ls[i:i + width])
            if w in seen:
                gone |= set(range(i, i + width))
            seen.add(w)
        out.append((doc_id, "\n".join(x for i, x in enumerate(ls) if i not in gone), len(ls), len(gone)))
    return out


def test_windows(spark):
    docs = [(1, "a\nb\nc\nd"), (2, "x\na\nb\nc\nd\ny"), (3, "q\nq\nq\nq\nq"), (4, "a\nb"), (5, "a\nb"),
            (6, "z\nb\nc\nd"), (7, "q\nq\nq")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert sorted(map(tuple, lines.dedup_lines(df).collect())) == brute(docs)
    assert sorted(map(tuple, lines.dedup_lines(df, width=2).collect())) == brute(docs, 2)


def test_edges(edge_docs, no_docs):
    got = lines.dedup_lines(edge_docs).collect()
    assert len(got) == len(EDGE_ROWS)
    by_id = {r.doc_id: r for r in got}
    assert by_id[7].n_removed == 0 and by_id[8].n_removed == 4 and by_id[8].text == ""
    assert by_id[1].text == "" and by_id[6].text == "x" * 200_000
    assert lines.dedup_lines(no_docs).count() == 0


def test_null_and_repeated_ids(spark):
    t = "a\nb\nc"
    df = spark.createDataFrame([(None, t), (1, t), (1, t), (1, t + "\nd"), (2, None)], "doc_id long, text string")
    got = sorted((str(r.doc_id), r.n_lines, r.n_removed) for r in lines.dedup_lines(df).collect())
    assert got == [("1", 3, 3), ("1", 3, 3), ("1", 4, 3), ("2", 1, 0), ("None", 3, 0)]


def test_many_lines_in_proportion(spark):
    """A hundred thousand lines a document: a search for every line would take minutes."""
    import time
    n = 100_000
    body = "\n".join(f"line {i}" for i in range(n))
    df = spark.createDataFrame([(1, body), (2, body + "\nlast"), (3, "first\n" + body)], "doc_id long, text string")
    start = time.time()
    got = {r.doc_id: r for r in lines.dedup_lines(df).collect()}
    assert time.time() - start < 60
    assert [(got[i].n_lines, got[i].n_removed) for i in (1, 2, 3)] == [(n, 0), (n + 1, n), (n + 1, n)]
    assert (got[1].text, got[2].text, got[3].text) == (body, "last", "first")
