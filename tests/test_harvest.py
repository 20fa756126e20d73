"""Harvest chains: long chains, circles, repeated answers and pages nothing leads to."""

import random

import pytest

from folianta.operators import harvest

OPEN, CLOSE = "<OAI-PMH><ListRecords>", "</ListRecords></OAI-PMH>"


def page(records, token):
    following = f"<resumptionToken>{token}</resumptionToken>" if token else ""
    return OPEN + "<record/>" * records + following + CLOSE


def chains(spark, rows):
    frame = spark.createDataFrame(rows, "harvest string, asked string, body string")
    found = harvest.harvest_chains(frame).collect()
    return {(r["harvest"], r["page"]): (r["rank"], r["records"], r["kept"], r["harvest_state"]) for r in found}


def walked(rows):
    """What a harvester that asks page after page sees."""
    bodies, ranks, states = {(h, a or ""): b for h, a, b in rows}, {}, {}
    for name in {h for h, _, _ in rows}:
        at, rank = "", 0
        while True:
            if (name, at) not in bodies:
                states[name] = "lost"
                break
            if (name, at) in ranks:
                states[name] = "loop"
                break
            body = bodies[name, at]
            ranks[name, at] = rank
            if "<error" in body or not body.startswith("<"):
                states[name] = "broken"
                break
            if "<resumptionToken>" not in body:
                states[name] = "complete"
                break
            at, rank = body.split("<resumptionToken>")[1].split("<")[0], rank + 1
    return ranks, states


def test_random_harvests_are_walked(spark):
    pick = random.Random(7)
    rows = []
    for h in range(25):
        size = pick.choice([1, 2, 3, 9, 33])
        for at in range(size):
            goal = at + 1 if pick.random() < 0.93 else pick.randrange(size + 2)
            body = page(at % 4, f"t{goal}" if at < size - 1 or pick.random() < 0.3 else "")
            if pick.random() < 0.05:
                body = pick.choice(["", "oops", "<OAI-PMH><error code='x'>y</error></OAI-PMH>"])
            rows.append((f"h{h}", f"t{at}" if at else None, body))
    pick.shuffle(rows)
    ranks, states = walked(rows)
    found = chains(spark, rows)
    assert {k: v[0] for k, v in found.items()} == {(h, a or ""): ranks.get((h, a or "")) for h, a, _ in rows}
    assert {k[0]: v[3] for k, v in found.items()} == states
    assert len(set(states.values())) == 4


def test_a_long_chain_takes_few_rounds(spark, monkeypatch):
    rounds = []
    keep = harvest.materialize
    monkeypatch.setattr(harvest, "materialize", lambda df, name: rounds.append(name) or keep(df, name))
    rows = [("h", f"t{at}" if at else None, page(1, f"t{at + 1}" if at < 499 else "")) for at in range(500)]
    found = chains(spark, rows)
    assert [found["h", f"t{at}" if at else ""][0] for at in range(500)] == list(range(500))
    assert rounds.count("jumps") <= 11


def test_repeated_answers_null_harvests_and_no_rows(spark):
    rows = [
        (None, None, "busy"), (None, None, page(2, "a")), (None, "a", page(1, "")), (None, "a", page(1, "")),
        ("x", "a", page(3, "")), ("y", None, ""),
    ]
    assert chains(spark, rows) == {
        (None, ""): (0, 2, True, "complete"), (None, "a"): (1, 1, True, "complete"),
        ("x", "a"): (None, 3, False, "lost"), ("y", ""): (0, None, False, "broken"),
    }
    assert chains(spark, []) == {}


@pytest.mark.parametrize("states", [["complete"], ["broken", "complete"]])
def test_summary_counts_what_was_read(spark, states):
    rows = [("h", None, page(2, "a")), ("h", "a", page(3, "b")), ("h", "b", "oops" if "broken" in states else page(1, ""))]
    frame = spark.createDataFrame(rows, "harvest string, asked string, body string")
    row = harvest.harvest_summary(harvest.harvest_chains(frame)).first()
    assert (row["pages"], row["pages_read"], row["records"]) == ((3, 2, 5) if "broken" in states else (3, 3, 6))
