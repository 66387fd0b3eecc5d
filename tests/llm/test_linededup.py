from fieldlens.llm import linededup


def brute(docs, window=3):
    """docs: list of (id, text) with distinct ids, in order."""
    seen, out = set(), {}
    for i, text in docs:
        if text is None:
            out[i] = (None, 0)
            continue
        lines = text.split("\n")
        counting = [k for k, x in enumerate(lines) if x.strip(" \t\r\x0b\x0c")]
        gone = set()
        for p in range(len(counting) - window + 1):
            at = counting[p:p + window]
            key = tuple(lines[k].strip(" \t\r\x0b\x0c") for k in at)
            if key in seen:
                gone.update(range(at[0], at[-1] + 1))
            seen.add(key)
        new = "\n".join(x for k, x in enumerate(lines) if k not in gone) if gone else text
        out[i] = (new, sum(k in gone for k in counting))
    return out


def check(spark, docs):
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r.doc_id: (r.text, r.lines_removed) for r in linededup.dedup_lines(df).collect()}
    assert got == brute(docs)
    return got


def test_against_brute_force(spark):
    p = "first line\nsecond line\nthird line"
    check(spark, [
        (1, p), (2, "own\n" + p + "\nown end"), (3, p), (4, "first line\n\n second line \r\n\nthird line\n\nmore"),
        (5, "a\nb\nc\nd\ne\nf"), (6, "x\nb\nc\nd\ny"), (7, "b\nc\nd\ne"), (8, "a\na\na\na\na\na"), (9, None), (10, ""),
        (11, "\n\n\n\n"), (12, "a\nb"), (13, "same\n" * 2000), (14, p + "\n" + p), (15, "a\r\nb\r\nc"), (16, "\na\nb\nc\n")])


def test_random(spark):
    import random
    rng = random.Random(4)
    got = check(spark, [(i, "\n".join(rng.choices(["a", "b", "c", " ", "", "d "], k=rng.randrange(30)))) for i in range(150)])
    assert sum(n for _, n in got.values()) > 200


def test_edges(spark, edge, empty):
    rows = linededup.dedup_lines(edge.withColumn("Lines_Removed", edge.n_chars)).collect()
    assert len(rows) == edge.count() and [c for c in rows[0].__fields__ if c.lower() == "lines_removed"] == ["lines_removed"]
    by_id = {r.doc_id: r for r in rows}
    assert by_id[10].text == "own start\n" and by_id[10].lines_removed == 3
    assert by_id[2].text is None and by_id[9].lines_removed == 0
    assert linededup.dedup_lines(empty).count() == 0


def test_equal_rows_and_shared_ids(spark):
    t, u = "a\nb\nc", "a\nb\nc\nd"
    df = spark.createDataFrame([(1, t), (1, t), (2, u), (2, t), (None, "a\nb\nc\nx")], "doc_id long, text string")
    rows = sorted((r.doc_id or 0, r.text, r.lines_removed) for r in linededup.dedup_lines(df).collect())
    assert rows == [(0, "a\nb\nc\nx", 0), (1, "", 3), (1, "", 3), (2, "", 3), (2, "d", 3)]


def test_native(spark, edge):
    plan = linededup.dedup_lines(edge)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan
