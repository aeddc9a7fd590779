import random

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from innlake.operators.frames import END, START, frame_messages
from innlake.session import scratch_path
from innlake.streaming.ingest import FrameAssembler

SCHEMA = "topic string, partition int, offset bigint, value string"
words = st.lists(st.sampled_from([START, END, "a", "b", "c"]), max_size=30)
LOOSE = settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))


def strict_replay(values):
    """offset -> frame, one message after the other."""
    kept, buffer, frame, is_open = {}, [], 0, False
    for offset, value in enumerate(values):
        if value == START:
            buffer, frame, is_open = [], frame + 1, True
        elif value == END:
            kept.update({o: frame for o in buffer} if is_open else {})
            is_open = False
        elif is_open:
            buffer.append(offset)
    return kept


def loose_replay(values):
    """offset -> (frame, times handed over); END keeps the buffer."""
    kept, buffer, frame = {}, [], 0
    for offset, value in enumerate(values):
        if value == START:
            buffer, frame = [], frame + 1
        elif value == END:
            for o in buffer:
                kept[o] = (frame, kept.get(o, (frame, 0))[1] + 1)
        else:
            buffer.append(offset)
    return kept


def log(spark, sequences):
    rows = [("t", p, 10 * o + p, v) for p, values in enumerate(sequences) for o, v in enumerate(values)]
    random.Random(5).shuffle(rows)
    return spark.createDataFrame(rows, SCHEMA)


@LOOSE
@given(st.lists(words, min_size=20, max_size=40), st.sampled_from([10, 30, 70, 100000]))
def test_blocks_agree_with_sequential_replay(spark, sequences, span):
    df = log(spark, sequences)
    strict = {(r.partition, r.offset): r.frame_id for r in frame_messages(df, True, span).collect()}
    assert strict == {(p, 10 * o + p): f for p, v in enumerate(sequences) for o, f in strict_replay(v).items()}
    loose = {(r.partition, r.offset): (r.frame_id, r.n_emissions) for r in frame_messages(df, False, span).collect()}
    assert loose == {(p, 10 * o + p): f for p, v in enumerate(sequences) for o, f in loose_replay(v).items()}


def test_micro_batches_agree_with_one_batch(spark):
    rng = random.Random(11)
    sequences = [[rng.choice([START, END, "a", "b", "c"]) for _ in range(rng.randrange(40))] for _ in range(30)]
    # Each log is cut at three random places; every batch is handled twice,
    # as after a failure between the writes and the commit.
    cuts = [sorted(rng.randrange(len(v) + 1) for _ in range(3)) for v in sequences]
    emitted = {}

    def emit(df, batch_id):
        emitted[batch_id] = [(r.partition, r.offset, r.frame_id) for r in df.collect()]

    assembler = FrameAssembler(scratch_path(spark, "frames-test"), emit, block_span=70)
    for batch in range(4):
        rows = [
            ("t", p, 10 * o + p, v) for p, values in enumerate(sequences)
            for o, v in enumerate(values) if sum(c <= o for c in cuts[p]) == batch
        ]
        df = spark.createDataFrame(rows, SCHEMA)
        for _ in range(2):
            assembler(df, batch)
    found = sorted(row for rows in emitted.values() for row in rows)
    expected = sorted((p, 10 * o + p, f) for p, v in enumerate(sequences) for o, f in strict_replay(v).items())
    assert found == expected
