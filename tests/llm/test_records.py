import zlib

import numpy as np
import pytest
from docs import awkward, frame, prose

from tickbars.llm import records
from tickbars.llm.queries import vocabulary
from tickbars.session import scratch_path


def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(vocabulary())


def in_order(rows):
    ids = {id(r): [*library().encode(r[1] or "", add_special_tokens=False).ids, records.END_ID] for r in rows}
    ordered = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, (r[1] or "").encode()))
    return [(r[0], ids[id(r)]) for r in ordered]


@pytest.mark.parametrize("file_bytes", [3000, records.FILE_BYTES])
def test_files_hold_all_documents_in_order(spark, file_bytes):
    rows = awkward() + [(1000 - i, prose(i, 50), "en", "a", 1) for i in range(60)]
    folder = scratch_path(spark, "records")
    files = records.write(frame(spark, rows, clashes=True), folder, vocabulary(), file_bytes=file_bytes)
    want = in_order(rows)
    read = sorted(records.read(spark, folder, files).collect(), key=lambda r: (r.part, r.place))
    assert [(r.doc_id, r.ids) for r in read] == want
    start, summary = 0, []
    for doc_id, ids in want:
        summary.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    got = [(r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in records.summaries(spark, folder, files).collect()]
    assert sorted(got, key=lambda r: r[1]) == summary
    mixed = records.shuffled(spark, folder, files, seed=5)
    assert sorted((str(r.doc_id), r.ids) for r in mixed.collect()) == sorted((str(i), ids) for i, ids in want)
    assert files.agg({"n_ids": "sum"}).first()[0] == start


def test_empty_table(spark):
    folder = scratch_path(spark, "records")
    files = records.write(frame(spark, []), folder, vocabulary())
    assert files.count() == 0 and records.summaries(spark, folder, files).count() == 0
    assert records.read(spark, folder, files).count() == 0 and records.shuffled(spark, folder, files).count() == 0


def test_damage_is_found():
    whole = records.frame(records.payload_of(-5, np.array([1, 2, 50256]), 2)) + records.frame(records.payload_of(None, np.array([70000]), 4))
    first, ids, at = records.unframe(memoryview(whole), 0)
    assert (first, ids.tolist()) == (-5, [1, 2, 50256])
    none, ids, end = records.unframe(memoryview(whole), at)
    assert (none, ids.tolist(), end) == (None, [70000], len(whole))
    for place in range(at):
        broken = bytearray(whole)
        broken[place] ^= 4
        with pytest.raises(ValueError):
            records.unframe(memoryview(broken), 0)
