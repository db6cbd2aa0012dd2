"""Shared by the tests."""

import random

COLUMNS = "id int, name string, note string, operation string, seq int"
DELETE = "operation = 'DELETE'"
COMMON = dict(keys=["id"], sequence_by="seq", delete_when=DELETE, except_columns=["operation", "seq"])


def rows(df):
    return sorted([tuple(r) for r in df.collect()], key=repr)


def random_events(seed, count=400, keys=6, hot_share=0.5, copies=50):
    """One key holds `hot_share` of the events, some of them exact copies; ties, NULLs and deletes occur."""
    draw = random.Random(seed)
    events = []
    for _ in range(count):
        key = 0 if draw.random() < hot_share else draw.randrange(1, keys)
        events.append(
            (
                key,
                draw.choice(["a", "b", None]),
                draw.choice(["x", "y", "z", None]),
                draw.choice(["APPEND", "UPDATE", "UPDATE", "UPDATE", "DELETE"]),
                draw.randrange(count // 3),
            )
        )
    events += [events[0]] * copies
    draw.shuffle(events)
    return events
