"""The treap against sorting, and the feed against a plain walk through the days."""

import math
import random
import zlib
from datetime import date, datetime, timedelta

import numpy as np
import pytest

from driftline.llm import leaderboard as lb

LINE = "sale_id long, line_no int, item_id long, vendor_id long, quantity int, amount double, discount double, flag string, shipped_at timestamp_ntz, batch string"


def test_treap_against_sorting():
    deal = random.Random(7)
    none = np.zeros(0, np.int64)
    treap, revenue = lb.Treap(none, none), {}
    for step in range(4000):
        item, cents = deal.randint(0, 150), deal.randint(-300, 500)
        known = item in revenue
        old = sorted(revenue, key=lambda i: (-revenue[i], i)).index(item) if known else 10**9
        revenue[item] = revenue.get(item, 0) + cents
        order = sorted(revenue, key=lambda i: (-revenue[i], i))
        rank = treap.add(item, cents, int(lb.priorities(np.array([item]))[0]))
        if not known or cents:
            assert rank == min(old, order.index(item))
        if step % 50 == 0:
            assert treap.first(10) == {i: revenue[i] for i in order[:10] if revenue[i] > 0}
            items, revenues = treap.nodes()
            assert items.tolist() == order and revenues.tolist() == [revenue[i] for i in order]
            again = lb.Treap(items, revenues)  # keys and priorities alone give the shape
            shape = lambda t: {t.item[n]: (t.item[t.left[n]], t.item[t.right[n]], t.size[n]) for n in t.at.values()}
            assert shape(again) == shape(treap)
            treap = again


def test_shard_survives_its_bytes():
    shard = lb.Shard()
    shard.learn(np.array([5, 3, 5]), np.array([10, 7, 20]))
    whole = [np.array(x) for x in ([1, 1, 2], [5, 3, 9], [8, 7, 7], [100, 50, 1], [2, 0, 0])]
    assert shard.feed(*whole) == [(1, 3, 7, 50, True), (1, 5, 8, 140, True)]  # item 9 isn't known
    again = lb.Shard(shard.dump())
    assert again.boards == {1: {5: 140, 3: 50}} and again.feed(*(np.array([x]) for x in (1, 5, 9, -200, 0))) == [(1, 5, 9, -60, False)]


def brute(lines, vendors, items):
    nation, price = {}, {}
    for v, n in vendors:
        if v is not None and n is not None:
            nation[v] = min(n, nation.get(v, n))
    for i, p in items:
        if i is not None:
            price[i] = max([x for x in (p, price.get(i)) if x is not None], default=None)
    cut = {}
    for sale, no, item, vendor, quantity, amount, flag, at in lines:
        h = zlib.crc32(",".join("" if x is None else str(x) for x in (sale, item, vendor, no)).encode())
        s = 19723 + h % 150 if at is None else (at.date() - date(1970, 1, 1)).days
        a = s + h % 7 + (20 if h % 5 == 0 else 0)
        cents = math.floor(100 * amount + 0.5) if amount is not None else (quantity or 0) * (math.floor(100 * (price.get(item) or 0) + 0.5))
        cut.setdefault(min(10, 1 + (a - 19723) * 10 // 180), []).append((a, s, nation.get(vendor), item, -cents if flag == "returned" else cents))
    latest, revenue, boards, out = None, {}, {}, []
    for batch in sorted(cut):
        kept = [r for r in cut[batch] if (latest is None or r[1] + 3 >= latest) and r[2] is not None and r[3] in price]
        latest = max([r[1] for r in cut[batch]] + ([] if latest is None else [latest]))
        for day in sorted({r[0] for r in kept}):
            for _, _, n, item, cents in (r for r in kept if r[0] == day):
                own = revenue.setdefault(n, {})
                own[item] = own.get(item, 0) + cents
            for n, own in revenue.items():
                board = sorted((i for i in own if own[i] > 0), key=lambda i: (-own[i], i))[:10]
                old = boards.get(n, [])
                for i in {*board, *old}:
                    x, y = (b.index(i) + 1 if i in b else None for b in (old, board))
                    if x != y:
                        out.append((n, day, i, batch, "enter" if x is None else "exit" if y is None else "move", x, y, own[i]))
                boards[n] = board
    return sorted(out, key=str)


@pytest.mark.parametrize("shard_items", [4096, 7])
def test_feed_against_a_plain_walk(spark, monkeypatch, shard_items):
    monkeypatch.setattr(lb, "SHARD_ITEMS", shard_items)
    monkeypatch.setattr(lb, "COMBINED_ROWS", 100)
    deal = random.Random(shard_items)
    some = lambda *x: deal.choice(x)
    lines = []
    for k in range(900):
        hot = k % 3 == 0  # a third of all lines has one item and vendor
        at = None if k % 50 == 0 else datetime(2024, 1, 1) + timedelta(days=deal.randint(0, 149), hours=deal.randint(0, 23))
        lines.append((some(k, k, None), some(1, 2, None), 4 if hot else some(None, 99, *range(30), *range(30)), 2 if hot else some(None, 77, *range(8), *range(8)), some(1, 3, None), some(None, 2.5, 10.0, 1.005, 7.0, 0.0), some("kept", "kept", "returned", None), at))
    lines += lines[:60]
    vendors = [(v, v % 3) for v in range(8)] + [(5, 7), (6, None), (None, 1)]
    items = [(i, None if i % 7 == 0 else 1.0 + i) for i in range(30)] + [(3, 50.0), (None, 9.0)]
    tables = spark.createDataFrame([(*r[:6], 0.1, *r[6:], "clash") for r in lines], LINE), spark.createDataFrame(vendors, "vendor_id long, nation_id int"), spark.createDataFrame(items, "item_id long, price double")
    got = lb.leaderboard(spark, *tables).collect()
    assert sorted(map(tuple, got), key=str) == brute(lines, vendors, items) and got
    if shard_items > 7:
        assert lb.leaderboard(spark, tables[0].limit(0), *tables[1:]).count() == 0
        assert lb.leaderboard(spark, tables[0], tables[1], tables[2].limit(0)).count() == 0
