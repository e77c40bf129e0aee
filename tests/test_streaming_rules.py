"""Duplicates and concentration over a stream against the batch rules."""

import random
import tempfile
from collections import Counter, defaultdict
from datetime import date, timedelta

from conftest import make_raw
from ledgerscreen.operators import clean as cl
from ledgerscreen.operators.rules import duplicate_keys
from ledgerscreen.schema import RAW_LEDGER
from ledgerscreen.streaming import whole_ledger as wl


def ledger(n=900, days=300, seed=4):
    """Raw rows with groups of copies, null vendors, bad rows and a hot entry."""
    r = random.Random(seed)
    day = lambda k: (date(2024, 1, 1) + timedelta(k)).isoformat()
    rows = []
    for k in range(n):
        at = r.randrange(days)
        vendor = None if k % 29 == 0 else "big" if at < 60 and k % 3 == 0 else f"v{r.randrange(25)}"
        amount = "900.0" if vendor == "big" else str(float(r.randrange(1, 400)))
        rows.append((f"T{k}", day(at), "10:00:00", "d", "a", vendor, amount, "Debit", "u", "x"))
    for k in range(120):                                     # copies on other ids, some of them the row itself
        src = rows[r.randrange(n)]
        rows.append((f"C{k}", *src[1:]) if k % 4 else src)
    rows += [(f"H{k}", day(150), "10:00:00", "d", "a", "hot", "5.0", "Debit", "u", "x") for k in range(300)]
    rows += [(None, day(9), "", "", "", "v1", "7", "", "", ""), ("B1", "no date", "", "", "", "v1", "7", "", "", "")]
    return rows


def arrive(spark, rows, folder, n_files, jitter, seed=1):
    """Files in which rows come up to ``jitter`` days late, one file after the other."""
    r = random.Random(seed)
    late = lambda x: (x[1] if x[1][:1] == "2" else "2024-01-01")
    order = sorted(rows, key=lambda x: date.fromisoformat(late(x)).toordinal() + r.randrange(jitter))
    size = -(-len(order) // n_files)
    return [make_raw(spark, order[k * size:(k + 1) * size]).coalesce(1) for k in range(n_files)]


def stream_of(spark, src):
    return spark.readStream.schema(RAW_LEDGER).option("maxFilesPerTrigger", 1).parquet(f"{src}/*")


def batch_members(spark, rows):
    je = cl.clean(make_raw(spark, rows))
    keys = {(x.vendor, x.amount, x.date) for x in duplicate_keys(je).collect()}
    return Counter((x.vendor, x.amount, x.date, x.transaction_id) for x in je.collect() if (x.vendor, x.amount, x.date) in keys)


def test_duplicates_shuffled_late_and_restarted(spark):
    rows = ledger()
    folder = tempfile.mkdtemp(prefix="ledgerscreen-stream-")
    files = arrive(spark, rows, folder, 4, jitter=8)
    run = lambda: wl.run_available(wl.duplicate_members(stream_of(spark, f"{folder}/in"), "20 days"), f"{folder}/out")
    for k in range(2):
        files[k].write.parquet(f"{folder}/in/{k}")
    early = Counter(tuple(x) for x in run().collect())
    for k in range(2, 4):
        files[k].write.parquet(f"{folder}/in/{k}")
    got = Counter(tuple(x) for x in run().collect())                # goes on from the checkpoint
    want = batch_members(spark, rows)
    assert got == want and early and early <= got and early != got and sum(k[0] == "hot" for k in got) == 300
    # copies of long past rows: behind the watermark, so neither new members nor old state
    alone = [x for x in rows if x[0] and x[1] < "2024-02-01" and (x[5], float(x[6])) not in {(k[0], k[1]) for k in want}][:20]
    make_raw(spark, [(f"L{k}", *x[1:]) for k, x in enumerate(alone)]).write.parquet(f"{folder}/in/9")
    assert len(alone) == 20 and Counter(tuple(x) for x in run().collect()) == want


def test_concentration_by_period(spark):
    rows = ledger(seed=5)
    folder = tempfile.mkdtemp(prefix="ledgerscreen-stream-")
    end = [("Z", "2030-01-01", "10:00:00", "d", "a", "end", "1.0", "Debit", "u", "x")]     # passes all periods before it
    for k, part in enumerate([*arrive(spark, rows, folder, 3, jitter=8), make_raw(spark, end)]):
        part.write.parquet(f"{folder}/in/{k}")
    out = wl.concentration(stream_of(spark, f"{folder}/in"), "20 days")
    got = {(x.period_start, x.vendor): (round(x.vendor_spend, 6), round(x.total_spend, 6))
           for x in wl.run_available(out, f"{folder}/out").collect()}
    spend = defaultdict(Counter)
    for x in cl.clean(make_raw(spark, rows)).collect():
        start = x.date - timedelta((x.date - date(1970, 1, 1)).days % 30)
        spend[start][x.vendor] += x.amount
    want = {(s, v): (a, sum(c.values())) for s, c in spend.items() for v, a in c.items()
            if v is not None and 100 * a / sum(c.values()) > 8}
    assert got == want and any(v == "big" for _, v in got)
    batch = {(x.period_start, x.vendor) for x in wl.concentration(make_raw(spark, rows)).collect()}
    assert batch == set(want)


def test_empty_stream(spark):
    folder = tempfile.mkdtemp(prefix="ledgerscreen-stream-")
    make_raw(spark, []).write.parquet(f"{folder}/in/0")
    assert wl.run_available(wl.duplicate_members(stream_of(spark, f"{folder}/in")), f"{folder}/d").count() == 0
    assert wl.run_available(wl.concentration(stream_of(spark, f"{folder}/in")), f"{folder}/c").count() == 0
