"""Readers: rows in file order, broken documents, the newest file, the first usable source, empty inputs."""

import json
import os
import uuid

import pytest
from pyspark.sql import functions as F

from tallywise.session import scratch_path
from tallywise.sources.files import newest_file, read_csv, read_json_lines, write_csv
from tallywise.sources.rejects import read_documents, split_documents
from tallywise.sources.schemas import ORDER, parse_orders, read_orders_json


def folder(spark):
    return scratch_path(spark, f"tallywise-tests/{uuid.uuid4().hex}")


def test_csv_rows_keep_their_place(spark):
    """Quoted line breaks, several part files: the position sorts as the rows were written."""
    path = folder(spark)
    rows = spark.range(0, 3000, numPartitions=5).select(F.col("id").alias("n"), F.concat(F.lit('a "q"\n,'), "id").alias("note"))
    write_csv(rows, path)
    back = read_csv(spark, path, "n bigint, note string", position="at")
    assert back.columns == ["n", "note", "at"]
    got = back.orderBy("at").collect()
    assert [r.n for r in got] == list(range(3000)) and got[7].note == 'a "q"\n,7'


def broken_orders(path):
    os.makedirs(path)
    good = {"id": 1, "name": "#1", "line_items": [{"line_no": 1, "sku": "A", "quantity": 2.0}, {"line_no": 2, "sku": "B", "quantity": 1.0}]}
    with open(f"{path}/page-1.json", "w") as f:
        f.write(json.dumps(good) + "\n\n" + json.dumps({**good, "name": "#2"})[:50] + "\n")
    with open(f"{path}/page-2.json", "w") as f:
        f.write("[1, 2]\n" + json.dumps({"id": 3, "name": "#3", "line_items": [{"line_no": 1, "quantity": "many"}]}) + "\n"
                + json.dumps({"id": 4, "name": "#4"}) + "\n")


def test_broken_documents_are_kept_apart_or_fail(spark, tmp_path):
    from tallywise.plans.flatten import flatten_orders
    path = str(tmp_path / "orders")
    broken_orders(path)
    found = read_documents(spark, path, ORDER, keep_broken=True)
    assert sorted((r.name, r.lineitem_number) for r in flatten_orders(found.rows).collect()) == [("#1", 1), ("#1", 2), ("#4", 1)]
    rejects = found.rejects.collect()
    assert sorted(r.value[:8] for r in rejects) == ["[1, 2]", '{"id": 1', '{"id": 3']
    assert {os.path.basename(r.file) for r in rejects} == {"page-1.json", "page-2.json"}
    with pytest.raises(Exception, match="not a document: .*page-[12].json"):
        read_documents(spark, path, ORDER).rows.collect()
    for lenient in (lambda: read_orders_json(spark, path), lambda: parse_orders(read_json_lines(spark, path))):
        with pytest.raises(Exception):
            lenient().collect()


def test_a_cut_catalogue_page_fails_or_is_rejected(spark):
    from tallywise.plans.inventory import PAGE_SCHEMA, catalog_flatten
    page = json.dumps({"data": {"products": {"edges": [{"node": {"id": "gid://x/7", "title": "t", "variants": {"edges": [
        {"node": {"sku": "S1", "inventoryQuantity": 3.0}}]}}}]}}})
    pages = spark.createDataFrame([(page, 1), (page[:-5], 2), ("", 3)], "body string, line_no int")
    with pytest.raises(Exception):
        catalog_flatten(pages).collect()
    found = split_documents(pages, PAGE_SCHEMA, "body")
    assert [r.line_no for r in found.rejects.collect()] == [2] and found.rows.count() == 1
    assert catalog_flatten(pages.filter("line_no = 1")).first().sku == "S1"


def test_newest_file_by_its_time(spark, tmp_path):
    for n, age in ((1, 50), (2, 10), (3, 30)):
        f = tmp_path / f"export_{n}.csv"
        f.write_text("a\n")
        os.utime(f, (1_700_000_000 - age, 1_700_000_000 - age))
    assert newest_file(spark, str(tmp_path / "export_*.csv")).endswith("export_2.csv")


def test_no_python_list_of_files():
    import inspect

    from tallywise.sources import files
    assert "globStatus" not in inspect.getsource(files) and "listStatus" not in inspect.getsource(files)
