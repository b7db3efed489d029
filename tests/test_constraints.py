"""The key rules of the constraint report against plain counting."""

from __future__ import annotations

import random
from collections import Counter

import pytest

from cargolake.plans import constraints
from cargolake.plans.constraints import FOREIGN_KEYS, UNIQUE, constraint_report

KEYS = {"suppliers": "id {0}, inn string", "warehouses": "id {0}", "purchase_headers": "id {0}, number string, supplier_id {0}, warehouse_id {0}",
        "products": "id {0}, sku string", "purchase_items": "id {0}, purchase_id {0}, product_id {0}",
        "stock_balances": "id {0}, product_id {0}, warehouse_id {0}"}


def made(seed, n, spread, kind="long", faults=0.1):
    """Rows per table: ids with copies and gaps, keys that mostly point to ids, NULLs."""
    rng = random.Random(seed)
    cast = str if kind == "string" else int
    number = lambda m: cast(spread(rng, m))
    ids = {t: [number(n) for _ in range(n)] for t in KEYS}
    rows = {}
    for table, ddl in KEYS.items():
        columns = [c.split()[0] for c in ddl.split(", ")]
        rows[table] = []
        for i in range(n):
            row = []
            for c in columns:
                parent = FOREIGN_KEYS.get(table, {}).get(c)
                if c == "id":
                    value = ids[table][i]
                elif parent:
                    value = rng.choice(ids[parent]) if rng.random() > faults else number(4 * n)
                else:
                    value = f"k{rng.randrange(n)}"
                row.append(None if rng.random() < 0.05 else value)
            rows[table].append(tuple(row))
    return rows


def counted(rows):
    """(table, rule) -> violations by comparing all keys."""
    out = {}
    columns = {t: [c.split()[0] for c in ddl.split(", ")] for t, ddl in KEYS.items()}
    for table, values in rows.items():
        at = {c: i for i, c in enumerate(columns[table])}
        for keys in UNIQUE[table]:
            if set(keys) <= set(at):
                known = [tuple(r[at[k]] for k in keys) for r in values if all(r[at[k]] is not None for k in keys)]
                out[table, f"unique: {', '.join(keys)}"] = len(known) - len(set(known))
        for c, parent in FOREIGN_KEYS.get(table, {}).items():
            if c in at and parent in rows:
                there = {r[0] for r in rows[parent]}
                out[table, f"foreign key: {c}"] = sum(n for k, n in Counter(r[at[c]] for r in values).items() if k is not None and k not in there)
    return out


def reported(spark, rows, kind="long"):
    tables = {t: spark.createDataFrame(values, KEYS[t].format(kind)).repartition(3) for t, values in rows.items()}
    found = {(r["table"], r["rule"]): r["violations"] for r in constraint_report(tables).collect()}
    return {k: n for k, n in found.items() if k[1].startswith(("unique", "foreign"))}, tables


CLOSE = {
    "small": lambda rng, m: rng.randrange(m),
    "around zero and below": lambda rng, m: rng.randrange(-40000, 40000),
    "two clusters": lambda rng, m: rng.randrange(m) + rng.choice([0, 10**12]),
}


@pytest.mark.parametrize("name", list(CLOSE))
@pytest.mark.parametrize("faults", [0, 0.1])
def test_bitmaps_count_like_plain_keys(spark, name, faults):
    rows = made(len(name), 400, CLOSE[name], faults=faults)
    found, tables = reported(spark, rows)
    assert found == counted(rows)
    assert all(s.dense for s in constraints.key_spaces(tables))


def test_ids_far_apart_and_texts_are_compared_as_keys(spark, monkeypatch):
    monkeypatch.setattr(constraints, "SLACK", 3)
    far = made(5, 300, lambda rng, m: rng.randrange(m) * 10**9)
    found, tables = reported(spark, far)
    assert found == counted(far)
    assert not any(s.dense for s in constraints.key_spaces(tables))
    texts = made(6, 300, lambda rng, m: rng.randrange(m), kind="string")
    assert reported(spark, texts, "string")[0] == counted(texts)


def test_keys_are_compared_only_where_a_bucket_shows_a_fault(spark, monkeypatch):
    asked = []
    real = constraints.orphans
    monkeypatch.setattr(constraints, "orphans", lambda tables, spaces, faulty: asked.append((
        {s.table for s in spaces}, {tuple(r) for r in faulty.collect()},
    )) or real(tables, spaces, faulty))
    rows = {t: [] for t in KEYS}
    rows["suppliers"] = [(i, f"i{i}") for i in range(1, 100001)]
    rows["warehouses"] = [(i,) for i in range(1, 50)]
    rows["purchase_headers"] = [(i, f"n{i}", i, 1 + i % 49) for i in range(1, 100001)]
    assert not any(n for n in reported(spark, rows)[0].values()) and asked == []      # no key was moved
    rows["suppliers"][70000:70001] = []
    found, _ = reported(spark, rows)
    assert {k: n for k, n in found.items() if n} == {("purchase_headers", "foreign key: supplier_id"): 1}
    assert asked == [({"suppliers"}, {(0, 3)})]        # one of four buckets


def test_empty_tables(spark):
    rows = {t: [] for t in KEYS}
    found, _ = reported(spark, rows)
    assert set(found) == set(counted(rows)) and not any(found.values())
