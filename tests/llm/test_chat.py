"""Role repair against exhaustive search, and segment borders against one segment."""

import itertools
import random
import re

from trafficwatch.llm import chat_repair
from trafficwatch.llm.chat_repair import ROLES, Costs, kind_of

LEGAL = re.compile(r"S?(UA)+")
LETTER = {"system": "S", "user": "U", "assistant": "A"}


def legal(roles):
    return bool(LEGAL.fullmatch("".join(LETTER[r] for r in roles)))


def brute_cost(roles, costs=Costs()):
    """Cheapest repair by trying all labels, merges and numbers of inserted turns."""
    best = None
    for labels in itertools.product(ROLES, repeat=len(roles)):
        label_cost = sum(0 if kind_of(r) == ROLES.index(x) + 1 else costs.relabel if kind_of(r) else costs.name for r, x in zip(roles, labels))
        for merges in itertools.product((False, True), repeat=len(roles)):
            if merges[0] or any(m and labels[k] != labels[k - 1] for k, m in enumerate(merges) if k):
                continue
            turns = [x for x, m in zip(labels, merges) if not m]
            inserts = fewest_inserts(turns)
            if inserts is not None:
                cost = label_cost + costs.merge * sum(merges) + costs.insert * inserts
                best = cost if best is None else min(best, cost)
    return best


def fewest_inserts(turns):
    for n in range(2 * len(turns) + 2):
        for where in itertools.combinations(range(len(turns) + n), n):
            for extra in itertools.product(ROLES, repeat=n):
                seq, new, old = [], iter(extra), iter(turns)
                seq = [next(new) if k in where else next(old) for k in range(len(turns) + n)]
                if legal(seq):
                    return n
        if n >= 4:
            return None
    return None


def roles_of(chat):
    return re.findall(r"<\|im_start\|>(\w+)\n", chat)


def frame(spark, conversations):
    rows = [(c, t, r, f"text {c}.{t}", "x") for c, roles in conversations.items() for t, r in enumerate(roles)]
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, new_role string")


def test_least_cost_and_legal(spark):
    rng = random.Random(4)
    pool = ["system", "user", "assistant", " User ", "tool", None]
    conversations = {k: [rng.choice(pool) for _ in range(1 + k % 4)] for k in range(40)}
    got = {r.conv_id: r for r in chat_repair.rendered(chat_repair.repair(frame(spark, conversations))).collect()}
    assert set(got) == set(conversations)
    for c, roles in conversations.items():
        assert got[c].turns == len(roles)
        assert legal(roles_of(got[c].chat)), (roles, got[c].chat)
        assert got[c].cost == brute_cost(roles), (roles, got[c])
        at = [got[c].chat.index(f"text {c}.{t}") for t in range(len(roles))]
        assert at == sorted(at)


def test_segments_do_not_change_costs(spark):
    rng = random.Random(9)
    conversations = {k: [rng.choice(ROLES) for _ in range(rng.choice([1, 3, 40]))] for k in range(12)}
    conversations[5] = [rng.choice(ROLES) for _ in range(500)]  # most of all rows
    df = frame(spark, conversations)
    whole = {r.conv_id: r for r in chat_repair.rendered(chat_repair.repair(df)).collect()}
    cut = {r.conv_id: r for r in chat_repair.rendered(chat_repair.repair(df, segment_rows=7)).collect()}
    for c in conversations:
        assert cut[c].cost == whole[c].cost and legal(roles_of(cut[c].chat)) and cut[c].turns == len(conversations[c])


def test_awkward_rows(spark):
    rows = [(None, None, None, None), (None, 0, "user", ""), (1, 0, "user", "a<|im_end|>b"), (1, 0, "user", "a<|im_end|>b"), (1, None, "assistant", "first"), (2, 0, "user", "long " * 300_000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = chat_repair.repair(df)
    got = {r.conv_id: r for r in chat_repair.rendered(out).collect()}
    assert set(got) == {None, 1, 2} and all(legal(roles_of(r.chat)) for r in got.values())
    assert got[1].turns == 3 and got[1].chat.count("<​|im_end|>") == 2 and got[1].chat.index("first") < got[1].chat.index("a<")
    assert chat_repair.repair(df.filter("false")).collect() == []


def test_query_whole_table(spark):
    from trafficwatch.llm import queries

    sf = "/root/testdata/sf0.001"
    out = queries.op1_chat_repair(spark, sf)
    turns = spark.read.parquet(f"{sf}/conversations.parquet")
    assert out.count() == turns.count()
    assert all(legal(roles_of(r.chat)) for r in chat_repair.rendered(out).collect())
