"""Aliases of surrogate keys and the addresses that follow them (CK-02)."""

from itertools import product

from aurum.operators.aliases import address_links, alias_classes, link_addresses

CONTACT = "source_system string, source_key string, first_name string, phone string, email string"
ADDRESS = "source_system string, source_customer_key string, gate string, file_date date"


def _classes(spark, rows):
    out = alias_classes(spark.createDataFrame(rows, CONTACT)).collect()
    assert len(out) == len({(r[0], r[1]) for r in out})
    groups = {}
    for r in out:
        groups.setdefault((r["source_system"], r["alias_id"]), set()).add(r["source_key"])
    return {(s, frozenset(k)) for (s, _), k in groups.items()}


def test_classes(spark):
    rows = [("N", "a", "Per", "1", "p@x"), ("N", "b", "per ", "1", None),       # phone
            ("N", "c", "Per", "2", "p@x"),                                      # e-mail: a, b, c by way of a
            ("N", "d", "Kari", "1", "p@x"),                                     # another first name
            ("N", "e", None, "1", "p@x"), ("N", "f", " ", "1", "p@x"),          # no first name
            ("N", "g", "Per", None, None), ("N", "h", "Per", "", " "),          # nulls and blanks agree with nothing
            ("M", "a", "Per", "1", "p@x"),                                      # another system
            ("N", "a", "Per", "1", "p@x"), ("N", "i", "Liv", "7", None), ("N", "i", "Liv", "8", None), ("N", "j", "Liv", "8", None)]
    assert _classes(spark, rows) == {("N", frozenset("abc")), ("M", frozenset("a")), ("N", frozenset("ij"))} | {
        ("N", frozenset(k)) for k in "defgh"}


def test_classes_match_closure_of_all_pairs(spark):
    rows = [("N", f"k{i}", ["Per", "Kari", None][i % 3], str(i * 7 % 23) if i % 5 else None, f"m{i * 11 % 29}" if i % 4 else None)
            for i in range(60)]
    label = {r[1]: r[1] for r in rows}
    pairs = [(x[1], y[1]) for x, y in product(rows, rows)
             if x[2] and x[2] == y[2] and ((x[3] and x[3] == y[3]) or (x[4] and x[4] == y[4]))]
    for _ in rows:
        for x, y in pairs:
            label[x] = label[y] = min(label[x], label[y])
    want = {("N", frozenset(k for k in label if label[k] == v)) for v in label.values()}
    assert _classes(spark, rows) == want


def test_hot_contact(spark):
    """One contact with very many keys is one class, linked by a row for each key."""
    rows = [("N", f"k{i:05}", "Per", "1", f"m{i}") for i in range(3000)]
    classes = alias_classes(spark.createDataFrame(rows, CONTACT))
    addr = spark.createDataFrame([("N", "k00007", "Old", None), ("N", "k00009", "New", None)], ADDRESS)
    links = address_links(addr, classes)
    assert links.count() == 2998 and [r[0] for r in links.select("owner_key").distinct().collect()] == ["k00007"]


def test_links(spark):
    import datetime as dt
    day = dt.date(2024, 1, 1)
    addr = spark.createDataFrame([("N", "a", "Storgata", day), ("N", "b", "Nygata", day + dt.timedelta(1)), ("N", "b", "Havn", day),
                                  ("N", "z", "Torg", day)], ADDRESS)
    contacts = spark.createDataFrame([("N", k, "Per", "1", None) for k in "abcd"] + [("N", "y", "Liv", "1", None)], CONTACT)
    links = address_links(addr, alias_classes(contacts))
    assert sorted((r[1], r[2]) for r in links.collect()) == [("c", "b"), ("d", "b")]
    out = sorted((r["source_customer_key"], r["gate"]) for r in link_addresses(addr, links).collect())
    assert out == [("a", "Storgata"), ("b", "Havn"), ("b", "Nygata"), ("c", "Havn"), ("c", "Nygata"), ("d", "Havn"), ("d", "Nygata"),
                   ("z", "Torg")]


def test_empty(spark):
    classes = alias_classes(spark.createDataFrame([], CONTACT))
    addr = spark.createDataFrame([], ADDRESS)
    assert classes.count() == 0 and link_addresses(addr, address_links(addr, classes)).count() == 0
