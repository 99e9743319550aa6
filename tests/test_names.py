import pytest

from tablesync.errors import SyncError
from tablesync.sources.names import literal, quote, resolve_entity


@pytest.mark.parametrize(
    "text, catalog, schema, full",
    [
        ("orders", "main", "sales", "main.sales.orders"),
        ("sales.orders", "main", None, "main.sales.orders"),
        ("prod.sales.orders", None, None, "prod.sales.orders"),
        ("prod.sales.orders", "main", "other", "prod.sales.orders"),
    ],
)
def test_missing_parts_come_from_the_defaults(text, catalog, schema, full):
    assert str(resolve_entity(text, catalog, schema)) == full


@pytest.mark.parametrize("text", ["a.b.c.d", "", "a..b", ".a", "a.", "`a`", "a.`b`"])
def test_bad_names_are_refused(text):
    with pytest.raises(SyncError):
        resolve_entity(text, "main", "sales")


@pytest.mark.parametrize(
    "text, catalog, schema, named",
    [("t", None, None, "catalog and no default schema"), ("t", "main", None, "schema"), ("s.t", None, None, "catalog")],
)
def test_an_unresolved_default_is_named(text, catalog, schema, named):
    with pytest.raises(SyncError, match=named):
        resolve_entity(text, catalog, schema)


def test_quoting():
    assert quote("we`ird") == "`we``ird`"
    assert resolve_entity("a.b.c d").quoted == "`a`.`b`.`c d`"


def test_literals(spark):
    for text in ("it's", "a\\b", "\\'", ""):
        assert spark.sql(f"SELECT {literal(text)}").first()[0] == text
