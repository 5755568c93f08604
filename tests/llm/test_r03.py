"""Near-duplicate links and line tidying."""

from pyspark.sql import functions as F

from dayrisk.llm import line_dedup, near_dedup


def test_a_crowd_of_near_copies_is_verified_about_once_a_member(spark, monkeypatch):
    words = [f"w{i}" for i in range(120)]
    texts = [" ".join([*words[:k], f"x{k}", *words[k + 1 :]]) for k in range(0, 120, 2)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    checked, verify = [], near_dedup._verified

    def counted(pairs, bags):
        checked.append(pairs.count())
        return verify(pairs, bags)

    monkeypatch.setattr(near_dedup, "_verified", counted)
    groups = near_dedup.near_groups(docs).collect()
    assert {r["class_id"] for r in groups} == {0} and {r["class_size"] for r in groups} == {60}
    assert sum(checked) < 2 * 60  # all leads of every member are several times as many


def test_runs_of_blanks_become_one_space(spark):
    page = "<p> a\t b  c\x0b</p><STYLE>x</style>\r\n<!-- d\n --><p>&nbsp; e\r f </p><header>g</header>"
    lines = spark.createDataFrame([(page,), (None,)], "html string").select(line_dedup.visible_lines(F.col("html"))).collect()
    assert [r[0] for r in lines] == [["a b c", "e f", "g"], []]


def test_links_of_near_copies_are_joined_in_one_go(spark, monkeypatch):
    """Labels before the blocks only spare looks: components are found once, over the links of all steps, and chains of leads close."""
    joined, components = [], near_dedup.connected_components

    def counted(nodes, edges):
        joined.append(edges.count())
        return components(nodes, edges)

    monkeypatch.setattr(near_dedup, "connected_components", counted)
    words = [f"w{i}" for i in range(200)]
    texts = []
    for k in range(40):  # each is near to its neighbours only: the links form a chain
        words[(k * 37) % 200] = f"x{k}"
        words[(k * 37 + 90) % 200] = f"y{k}"
        texts.append(" ".join(words))
    order = [(k * 17) % 40 for k in range(40)]
    texts = [texts[k] for k in order] + ["apart " * 9]
    groups = {r["doc_id"]: r for r in near_dedup.near_groups(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert {groups[k]["class_id"] for k in range(40)} == {0} and groups[0]["class_size"] == 40
    assert groups[40]["class_id"] == 40
    assert len(joined) <= 1
