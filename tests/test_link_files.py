"""What the link sink writes, the link source reads back whole; question lists and voter lists."""

from linkspark.operators.retrieve import voter_contexts, voter_retrievers
from linkspark.sources.records import read_questions
from linkspark.sources.links import read_link_file, write_link_file


def test_all_records_come_back(spark, tmp_path):
    rows = [(q, "t", "", "T", None) for q in range(5)] + [(q, "t", "c", "T", "C") for q in range(0, 5, 2)]
    links = spark.createDataFrame(rows, "question_id long, tlc string, clc string, tbl string, col string").coalesce(1)
    write_link_file(links, str(tmp_path / "links"))
    got = {(r.question_id, r.tbl, r.col) for r in read_link_file(spark, str(tmp_path / "links")).collect()}
    assert got == {(q, "T", "C" if q % 2 == 0 else None) for q in range(5)}


def test_last_list_of_a_repeated_table_counts(spark, tmp_path):
    (tmp_path / "x.json").write_text('{"question_id": 1, "schema_links": "{\\"T\\": [\\"a\\"], \\"U\\": NaN, \\"T\\": [\\"b\\"]}"}\n')
    got = {(r.tbl, r.col) for r in read_link_file(spark, str(tmp_path / "x.json")).collect()}
    assert got == {("T", "b"), ("U", None)}


def test_question_lists(spark, tmp_path):
    (tmp_path / "list.json").write_text('[{"question_id": 1, "db_id": "a", "question": "x\\ny", "more": 2},\n {"question_id": 2}]')
    (tmp_path / "lines.json").write_text('{"question_id": 1, "db_id": "a", "question": "x\\ny", "more": 2}\n{"question_id": 2}\n')
    for name, json_list in (("list", True), ("lines", False)):
        got = read_questions(spark, str(tmp_path / f"{name}.json"), json_list).collect()
        assert sorted(tuple(r) for r in got) == [(1, "a", "x\ny"), (2, None, None)]


def test_voter_lists(spark):
    specs = spark.createDataFrame([("a:bm25, ,b,  s3:c : embed ,d:",), ("",), (None,)], "spec string")
    voters = voter_retrievers(specs, "rrf")
    assert sorted(tuple(r)[1:] for r in voters.collect()) == [
        (1, "a", "bm25"), (2, "b", "rrf"), (3, "s3:c", "embed"), (4, "d", "")]
    ranked = spark.createDataFrame([("bm25", 7, t, t) for t in (1, 2, 3)] + [("rrf", 7, 9, 1)], "retriever string, question_id long, table_idx long, rank long")
    got = voter_contexts(voters, ranked, 2).select("voter", "table_idx").collect()
    assert sorted(map(tuple, got)) == [(1, 1), (1, 2), (2, 9)]
