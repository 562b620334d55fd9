import duckdb

from actlens.llm import line_dedup as L
from actlens.llm.sql import LINES_CTE


def rows():
    out = []
    for i in range(200):
        host = ["big", "big", "small", None][i % 4]
        head = ["Menu", " Menu\t", "Menu\r"][i % 3] if i % 5 else "Other"
        out.append((i, f"{head}\nbody {i}\n\nline {i % 90}\nbody {i}\nend {i * 7}\nx{i}\ny{i}", host))
    out += [(300 + i, "copied body\nof one page", "big") for i in range(40)]
    out += [(400 + i, f"Menu\nMenu\nOnly{i // 2}", "big") for i in range(4)]
    out += [(500, None, "big"), (501, "", "small"), (502, "\n\n", None), (503, "Menu", "small"), (504, "Menu", "lonely"), (500, None, "big")]
    return out


def test_same_as_sql(spark):
    data = rows()
    docs = spark.createDataFrame([(*r, 7, 8, "x", 9) for r in data],
                                 "doc_id long, text string, source string, n int, n_lines int, host string, `a b` int")
    got = L.drop_boilerplate(docs.repartition(3)).select("doc_id", "text", "n_lines", "n_dropped").collect()
    assert L.drop_boilerplate(docs, counts=False).columns == docs.columns
    frame = docs.select("doc_id", "text", "source").toPandas()
    con = duckdb.connect()
    con.register("documents", frame)
    want = con.sql(f"WITH {LINES_CTE} SELECT doc_id, array_to_string(kept, chr(10)), coalesce(len(lines), 0), "
                   "coalesce(len(lines) - len(kept), 0) FROM kept").fetchall()
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    by_id = {r.doc_id: r for r in got}
    assert by_id[1].text.startswith("body 1\n\n") and by_id[1].n_dropped == 1
    assert by_id[300].text == "copied body\nof one page"  # copies of a page are one page
    assert by_id[503].text == "" and by_id[503].n_dropped == 1  # a page of nothing but boilerplate
    assert by_id[504].text == "Menu" and by_id[500].text is None  # the only page of its host
    assert L.drop_boilerplate(docs.limit(0)).collect() == []


def test_frequency_is_relative_to_the_host(spark):
    data = [(i, f"Menu\na {i}\nb {i}", "one") for i in range(100)] + [
        (1000 + i, ("Menu\n" if i < 20 else "") + f"a {i}\nb {i}", "two") for i in range(2000)]
    docs = spark.createDataFrame(data, "doc_id long, text string, source string")
    out = {r.doc_id: r.n_dropped for r in L.drop_boilerplate(docs).collect()}
    assert all(out[i] == 1 for i in range(100)) and all(out[1000 + i] == 0 for i in range(2000))


def test_no_page_or_host_is_exempt(spark):
    """Long templates with short bodies, and hosts of a few pages."""
    menu = "\n".join(f"Menu {i}" for i in range(5))
    data = [(i, f"{menu}\nown line {i}", "long template") for i in range(300)]
    data += [(1000 + i, f"Home\nown line {i}\nand {i}", f"small {i // 4}") for i in range(400)]
    data += [(2000 + i, f"Home\nown line {i}", f"two {i // 2}") for i in range(20)] + [(3000, "alone\nhere", "one page")]
    docs = spark.createDataFrame(data, "doc_id long, text string, source string")
    out = {r.doc_id: r for r in L.drop_boilerplate(docs).collect()}
    assert all(out[i].text == f"own line {i}" and out[i].n_dropped == 5 for i in range(300))
    assert all(out[1000 + i].text == f"own line {i}\nand {i}" for i in range(400))
    assert all(out[2000 + i].text == f"own line {i}" for i in range(20)) and out[3000].text == "alone\nhere"


def test_hot_host_and_long_texts(spark):
    """A host with most pages, another's lines beside it, and a text of 200,000 lines."""
    data = [(i, f"Head\nbody {i}", "hot") for i in range(3000)] + [(5000 + i, f"Head\nbody {i}", f"h{i}") for i in range(50)]
    data += [(9000, "\n".join(["Head", *(f"line {i}" for i in range(200_000))]), "hot")]
    docs = spark.createDataFrame(data, "doc_id long, text string, source string").repartition(4)
    out = {r.doc_id: r.n_dropped for r in L.drop_boilerplate(docs).select("doc_id", "n_dropped").collect()}
    assert all(out[i] == 1 for i in range(3000)) and all(out[5000 + i] == 0 for i in range(50)) and out[9000] == 1
