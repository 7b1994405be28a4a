"""S-1 … S-5 on the fixture cases of FIXTURES.md §2."""

from pyspark.sql import functions as F

from marquee.functions.jsoncols import first_by_job, first_n_names, json_names, split_trim

CASES = [
    ('[{"id": 5, "name": "Sea tales"}, {"id": 9, "name": "Maps"}]', ["Sea tales", "Maps"]),
    ('[{"id": 1}]', [""]),                                  # object without name
    ('["a", 3, 1.5]', ["a", "3", "1.5"]),                  # strings and numbers
    ("[]", []),
    ("{}", []),                                              # object, not a list
    ("", []),
    ("   ", []),
    (None, []),
    ("[{broken", []),
    ("[{'id': 5, 'name': 'Sea tales'}]", ["Sea tales"]),         # Python-literal quotes
    ('[null, {"name": "X"}]', ["X"]),                        # null items dropped
    ('{"k": 69}', []),
]


def test_json_names(spark):
    df = spark.createDataFrame([(i, c) for i, (c, _) in enumerate(CASES)], "i int, c string")
    got = {r["i"]: r["n"] for r in df.select("i", json_names("c").alias("n")).collect()}
    for i, (_, want) in enumerate(CASES):
        assert got[i] == want, (CASES[i][0], got[i])


def test_first_by_job(spark):
    data = [
        (0, '[{"job": "Writer", "name": "A"}, {"job": "Director", "name": "B"}, {"job": "Director", "name": "C"}]'),
        (1, '[{"job": "Writer", "name": "A"}]'),
        (2, '[{"name": "nojob"}, {"job": "Director", "name": "D"}]'),
        (3, None),
        (4, "broken"),
        (5, '[{"job": "Director"}]'),
    ]
    df = spark.createDataFrame(data, "i int, crew string")
    got = dict(df.select("i", first_by_job("crew").alias("d")).collect())
    assert got == {0: "B", 1: "", 2: "D", 3: "", 4: "", 5: ""}


def test_first_n_names(spark):
    cast = '[{"name": "a"}, {"name": "b"}, {"name": "c"}, {"name": "d"}, {"name": "e"}, {"name": "f"}]'
    df = spark.createDataFrame([(0, cast), (1, '[{"name": "x"}, {"id": 2}]'), (2, None)], "i int, c string")
    got5 = dict(df.select("i", first_n_names("c", 5).alias("n")).collect())
    got3 = dict(df.select("i", first_n_names("c", 3).alias("n")).collect())
    assert got5[0] == ["a", "b", "c", "d", "e"] and got3[0] == ["a", "b", "c"]
    assert got5[1] == ["x", ""] and got5[2] == []


def test_split_trim(spark):
    df = spark.createDataFrame([(0, "Drama , Crime"), (1, "Drama,"), (2, None), (3, "")], "i int, g string")
    got = dict(df.select("i", split_trim("g").alias("l")).collect())
    assert got == {0: ["Drama", "Crime"], 1: ["Drama", ""], 2: [], 3: [""]}


def test_join_list_roundtrip(spark):
    df = spark.createDataFrame([('[{"name": "A"}, {"name": "B"}]',)], "c string")
    assert df.select(F.array_join(json_names("c"), ", ")).first()[0] == "A, B"
