"""Tool calls of all conversations, and of long reference chains in a hot conversation, against plain Python."""

import json
import re
import zlib

import duckdb

from dwspark.llm import chat, queries
from . import helpers as h


def brute_force(calls, results, schemas):
    """calls (conv, id, position, name, arguments text) and results (conv, id, position, content) with unique identifiers:
    {(conv, id): (status, valid, errors, arguments, layer, place, result)}, and the orphans."""
    known = {(c, i): (p, n, json.loads(a)) for c, i, p, n, a in calls}
    answers = {(c, i): x for c, i, _, x in results}
    needs = {k: {(k[0], r) for r in chat.references(v[2])} for k, v in known.items()}
    layer, rounds = {}, 0
    while True:  # one layer a round
        ready = [k for k in known if k not in layer and all(n not in known or n in layer for n in needs[k])]
        if not ready:
            break
        layer |= dict.fromkeys(ready, rounds)
        rounds += 1
    place = {}
    for conv in {c for c, _ in known}:
        own = sorted((k for k in layer if k[0] == conv), key=lambda k: (layer[k], known[k][0], k[1]))
        place |= {k: i for i, k in enumerate(own)}
    out = {}
    for k, (_, name, value) in known.items():
        errors = chat.schema_errors(value, schemas[name]) if name in schemas else ["$: unknown tool"]
        errors = errors + sorted(f"$: unknown call {n[1]}" for n in needs[k] if n not in known)
        status = "cycle" if k not in layer else "linked" if k in answers else "no result"
        out[k] = (status, not errors, errors, chat.canonical(value), layer.get(k), place.get(k), answers.get(k))
    return out, {k for k in answers if k not in known}


def _compare(rows, want, orphans):
    found = {(r.conv_id, r.call_id): r for r in rows if r.status != "orphan"}
    assert {(r.conv_id, r.call_id) for r in rows if r.status == "orphan"} == orphans
    assert set(found) == set(want)
    for k, r in found.items():
        value = json.loads(r.json)
        assert (r.status, r.valid, r.errors, r.arguments, r.layer, r.place, value["result"]) == want[k], k
        assert r.json == json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False) and value["id"] == r.call_id


def test_every_call_and_result(spark):
    turns = duckdb.sql(f"SELECT conv_id, turn, role, text FROM '{h.SF}/conversations.parquet'").fetchall()
    calls, results = [], []
    for c, t, role, text in turns:
        if role == "assistant":
            rank = t // 2
            after = {"after": {"$result": f"call_{(rank - 1) // 2 * 2 + 1}"}} if rank > 0 else {}
            words = len(re.split(r"\s+", text.strip(" "), flags=re.ASCII))
            name = list(chat.TOOLS)[zlib.crc32(text.encode()) % len(chat.TOOLS)]
            calls.append((c, f"call_{t}", t, name, json.dumps({**after, "text": text, "words": words, "lines": text.count("\n") + 1})))
        elif role == "user" and t > 0:
            results.append((c, f"call_{t - 1}", t, text))
    want, orphans = brute_force(calls, results, chat.TOOLS)
    assert {s[0] for s in want.values()} == {"linked", "no result"}
    _compare(queries.queries()["op1_tool_calls"](spark, h.SF).collect(), want, orphans)


def test_chains_forks_and_cycles_of_a_hot_conversation(spark):
    import random

    r = random.Random(6)
    calls = []
    for i in range(800):  # one conversation with nearly all rows; forks of up to three references
        back = {f"r{k}": {"$result": f"c{r.randrange(max(0, i - 400), i)}"} for k in range(r.randint(0, 3))} if i % 200 else {}
        calls.append((1, f"c{i}", i, "t", json.dumps({"n": i + 1, "x": back})))
    calls += [(2, f"c{i}", i, "t", json.dumps({"n": 1, "x": [{"$result": f"c{i - 1}"}] if i else []})) for i in range(12)]  # a chain
    calls += [(3, "a", 0, "t", '{"n":1,"x":{"$result":"b"}}'), (3, "b", 1, "t", '{"n":1,"x":{"$result":"a"}}'), (3, "c", 2, "u", '{"n":1,"x":{"$result":"zz"}}')]
    results = [(c, i, 9000 + p, f"result {i}") for c, i, p, _, _ in calls if p % 7] + [(9, "c0", 1, "nobody asked")]
    schemas = {"t": {"type": "object", "required": ["n"], "properties": {"n": {"type": "integer", "maximum": 500}, "x": {}}}}
    want, orphans = brute_force(calls, results, schemas)
    assert {x[0] for x in want.values()} == {"linked", "no result", "cycle"}
    c = spark.createDataFrame(calls, "conv_id long, call_id string, position long, name string, arguments string")
    a = spark.createDataFrame(results, "conv_id long, call_id string, position long, content string")
    _compare(chat.link(c, a, schemas).collect(), want, orphans)
