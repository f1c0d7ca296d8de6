from cohortloom.llm import line_dedup as L


def cleaned(spark, rows):
    return {r.doc_id: r.text for r in L.drop_recurring(spark.createDataFrame(rows, "doc_id long, text string")).collect()}


def test_several_templates_in_a_leaf(spark):
    """Two pairs of near-equal lines in one leaf, whose vote agrees with neither, and prose that begins alike."""
    start = "all of them begin"
    tail = {name: [f"{name}{chr(97 + i)}" for i in range(10)] for name in "pqrs"}
    a, b = [" ".join([start, *tail["p"]]), " ".join([start, *tail["p"][:-1], "zz"])], [" ".join([start, *tail["q"]]), " ".join([start, "zz", *tail["q"][1:]])]
    alone = [" ".join([start, *tail[n]]) for n in "rs"]
    got = cleaned(spark, [(1, a[0]), (2, b[0]), (3, a[1]), (4, b[1]), (5, alone[0]), (6, alone[1])])
    assert got == {1: a[0], 2: b[0], 3: "", 4: "", 5: alone[0], 6: alone[1]}


def test_exact_copies_of_numbers(spark):
    log = "2024-01-02 10:11:12 17 404 10.0.0.1 a1 b2 c3 d4 e5 end"
    other = log.replace("404", "405")
    got = cleaned(spark, [(1, log), (2, log), (3, other), *[(10 + i, "1 2 x") for i in range(10)], *[(30 + i, "1 3 x") for i in range(9)]])
    assert [got[i] for i in (1, 2, 3)] == [log, "", other]
    assert [got[10 + i] for i in range(10)] == ["1 2 x"] + [""] * 9 and all(got[30 + i] for i in range(9))


def test_short_lines_with_one_open_place(spark):
    names = "Ann Bob Cy Dee Eve Fay Gus Hal Ida Joe".split()
    rows = [(i, f"Posted by {name} in News") for i, name in enumerate(names)]
    few = [(20 + i, f"Written by {name} for Sports") for i, name in enumerate(names[:9])] + [(20, "Written by Kim for Sports")]
    got = cleaned(spark, [*rows, *few])
    assert [got[i] for i in range(10)] == [rows[0][1]] + [""] * 9
    assert all(got[20 + i] for i in range(9)), "nine documents are too few"
    numbers = [(i, f"{i} 2 3 4 x") for i in range(12)]
    assert cleaned(spark, numbers) == dict(numbers)
