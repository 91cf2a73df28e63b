import hashlib
import math
import re
import zlib
from collections import defaultdict

import pytest

from harvestline.llm import conversations

TURNS = "conv_id long, turn long, role string, text string"


def brute(rows):
    """Every node by its sequence of turns, every subtree by looking at all nodes."""
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
            turns[conv].append((turn is not None, turn or 0, digest, role, text))
    own = {c: [t[3:] for t in sorted(ts)] for c, ts in turns.items()}
    whole = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        whole[c] = tuple(own.get(c - int(math.fmod(c, 20)), [])[:h] + ts[h:])
    members, ends = defaultdict(list), defaultdict(list)
    for c, ts in sorted(whole.items()):
        ends[ts].append(c)
        for d in range(len(ts) + 1):
            members[ts[:d]].append(c)
    children = defaultdict(int)
    for node in members:
        if node:
            children[node[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for node, own_members in members.items():
        words = len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
        for d in range(len(node) + 1):
            leaves[node[:d]] += not children[node]
            saved[node[:d]] += (len(own_members) - 1) * words
    return sorted(
        (
            m[0], len(node), members[node[:-1]][0] if node else None, len(m), children[node],
            leaves[node], saved[node],
            hashlib.sha256(",".join(map(str, ends[node])).encode()).hexdigest(),
        )
        for node, m in members.items()
    )


def found(spark, rows, **how):
    frame = spark.createDataFrame(rows, TURNS)
    out = conversations.prefix_trie(frame, **how)
    assert out.columns == [
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        "ends_sha256",
    ]
    return sorted((tuple(r) for r in out.collect()), key=lambda r: r[:2])


def check(spark, rows, **how):
    assert found(spark, rows, **how) == sorted(brute(rows), key=lambda r: r[:2])


def shared_starts(n=90):
    """Conversations of many lengths, most of which begin alike."""
    rows = []
    for c in range(n):
        length = (c * 7) % 9
        for t in range(length):
            text = f"turn {t} of group {c % 3 if t > 2 else 0}" + " tail" * (t > 5 and c % 2)
            rows.append((c + 3, t, ("user", "assistant")[t % 2], text))
    return rows


@pytest.mark.parametrize("height", [2, 3, 4])
def test_nodes_equal_brute_force(spark, height):
    check(spark, shared_starts(), height=height)


def test_null_roles_texts_turns_and_ids(spark):
    rows = shared_starts(30) + [
        (200, None, None, None),
        (200, 1, "user", None),
        (200, 1, None, "a  b\tc\nd"),
        (201, 0, "user", ""),
        (201, 0, "user", ""),
        (201, 0, "user", "same turn twice"),
        (201, 0, "user", "same turn twice"),
        (-7, 3, "user", "negative id"),
        (-20, 3, "user", "its family"),
        (None, 0, "user", "of no conversation"),
    ]
    check(spark, rows)


def test_conversations_that_lose_all_turns_are_members_of_the_root(spark):
    rows = [(c, 0, "user", "only turn") for c in range(1, 19)]  # none with turns to give
    out = found(spark, rows)
    assert out == brute(rows)
    root = next(r for r in out if r[1] == 0)
    assert root[3] == 18 and root[2] is None


def test_one_long_conversation_spreads_and_sums_over_many_bands(spark):
    rows = [(40, t, "user", f"t{t} word") for t in range(3000)]
    rows += [(41 + k, t, "user", f"t{t} word") for k in range(4) for t in range(0, 2990 - k)]
    wanted = sorted(
        brute([r for r in rows if r[1] < 60]), key=lambda r: r[:2]
    )
    assert found(spark, [r for r in rows if r[1] < 60]) == wanted
    out = found(spark, rows)
    root, deepest = out[0], max(out, key=lambda r: r[1])
    assert deepest[1] == 3000 and root[3] == 5
    assert root[5] == sum(r[4] == 0 for r in out)
    assert root[6] == sum((r[3] - 1) * 2 for r in out if r[1])


def test_many_ends_in_one_node_are_joined_over_chunks(spark):
    rows = [(c * 20, 0, "user", "hello there") for c in range(2000)]
    check(spark, rows)


def test_no_rows_and_other_columns(spark):
    assert found(spark, []) == []
    frame = spark.createDataFrame(
        [(1, 0, "user", "a", 5, 6)], TURNS + ", depth long, k1 long"
    )
    assert conversations.prefix_trie(frame).count() in (1, 2)
