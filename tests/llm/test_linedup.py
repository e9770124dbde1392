import duckdb

from listing_lake.llm import linedup
from listing_lake.llm.common import table
from tests import oracle_check

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, n_lines long, of_doc int, dropped_lines int, template int, line int"


def run(spark, docs):
    frame = spark.createDataFrame([(*d, 0, 1, 2, 3, 4) for d in docs], DOCS)
    return {(r.doc_id, r.n_dropped, r.n_lines): r.text for r in linedup.drop_recurring(frame).collect()}


def test_documents_against_sql(spark):
    found = linedup.drop_recurring(table(spark, SF, "documents")).select("doc_id", "text", "n_lines", "n_dropped")
    want = oracle_check.frame_of_sql(oracle_check.duck(SF), linedup.ORACLE_SQL)
    assert oracle_check.compare(oracle_check.frame_of(found), want) == "ok"


def test_variable_fields(spark):
    words = [f"w{i}" for i in range(16)]
    line = " ".join(words)
    field = " ".join(words[:6] + ["other", "names"] + words[8:])  # within one segment
    apart = " ".join(words[:3] + ["other"] + words[4:14] + ["names", "w15"])  # in two segments
    found = run(spark, [(1, line), (2, field), (3, apart), (4, line + " more"), (5, "own text stays as it is"), (6, "page 3 of 10 pages"), (7, "page 44 of 9 pages")])
    assert found == {
        (1, 0, 1): line, (2, 1, 1): "", (3, 0, 1): apart, (4, 0, 1): line + " more",
        (5, 0, 1): "own text stays as it is", (6, 0, 1): "page 3 of 10 pages", (7, 1, 1): "",
    }


def test_identifiers_are_variable(spark):
    logs = [f"user u{i}x of host{i * 7}.example logged in" for i in range(10)]
    tables = [f"total{kind} x{i} 22 y{i + 5} 7" for kind in "ab" for i in range(2)]  # mostly figures: digits alone vary
    found = run(spark, [*enumerate(logs), *enumerate(tables, start=20)])
    kept = {(0, 0, 1): logs[0], (20, 0, 1): tables[0], (22, 0, 1): tables[2]}
    assert found == kept | {(i, 1, 1): "" for i in (*range(1, 10), 21, 23)}


def test_brief_lines_recur_from_a_number_of_documents_on(spark):
    enough, few = linedup.BRIEF_DOCS, linedup.BRIEF_DOCS - 1
    docs = [(i, "All rights reserved.\n" + ("Yes.\nYes." if i < few else "No.") + f"\nown words of {'x' * (i + 1)} here alone") for i in range(enough)]
    found = run(spark, docs)
    assert found[0, 0, 4] == docs[0][1] and found[few, 1, 3] == docs[few][1].split("\n", 1)[1]
    assert all(found[i, 1, 4] == docs[i][1].split("\n", 1)[1] for i in range(1, few))


def test_scripts_without_blanks(spark):
    line, brief = "\u8fd9\u662f\u4e00\u884c\u6ca1\u6709\u7a7a\u683c\u7684\u6587\u5b57" * 3, "\u7b2c\u4e00\u7ae0"
    assert run(spark, [(1, f"{line}\n{brief}"), (2, f"{brief}\n{line}")]) == {(1, 0, 2): f"{line}\n{brief}", (2, 1, 2): brief}


def test_odd_rows(spark):
    shared = "this line is in many documents"
    docs = [
        (1, f"{shared}\nfirst own line of one\n{shared}"), (2, f"\n{shared}\n\nlast"), (2, f"\n{shared}\n\nlast"), (3, None), (4, ""),
        (None, shared), (5, "too short line"), (6, "too short line"), (7, "x y z u v " * 30_000), (8, "\n".join([shared] * 5000)),
    ]
    assert run(spark, docs) == {
        (1, 0, 3): docs[0][1], (2, 1, 4): "\n\nlast", (3, 0, 0): None, (4, 0, 1): "", (None, 0, 1): shared,
        (5, 0, 1): "too short line", (6, 0, 1): "too short line", (7, 0, 1): docs[8][1], (8, 5000, 5000): "",
    }
    assert run(spark, []) == {}


def test_sql_of_odd_rows(spark):
    con = duckdb.connect()
    rows = [(1, "a b c d e f\nx"), (2, "a b  c d e f\r\n\nx"), (3, None), (4, ""), (None, "a b c d e f"), (5, "a b c d e 77"), (6, "a b c d e 8")]
    rows += [(7, "1 2 3 a"), (8, "1 2 3 a\tb 4 \u00e9\u00e9 x9y"), (9, "1 2 3 a\tb 4 \u00e9\u00e9 x9y"), (10, "a" * 50 + " \u4e2d"), (11, "a" * 50 + "  \u4e2d\n\t \n")]
    rows += [(i, f"brief {i}\r") for i in range(20, 45)]
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    found = linedup.drop_recurring(spark.createDataFrame(rows, "doc_id long, text string"))
    want = oracle_check.frame_of_sql(con, linedup.ORACLE_SQL)
    assert oracle_check.compare(oracle_check.frame_of(found), want) == "ok"


def test_runs_without_python(spark):
    frame = linedup.drop_recurring(table(spark, SF, "documents"))
    hashed = linedup.templates(table(spark, SF, "documents"))
    for df in (frame, hashed, linedup.recurring(hashed)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
