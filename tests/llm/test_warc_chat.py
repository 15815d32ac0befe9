import gzip
import hashlib

from pyspark.sql import functions as F

from quarry.llm.chat_format import CHATML, PROBE, escape, format_conversations, read_back, unescape, unescape_role, escape_role
from quarry.llm.warc import parse_record, read_records, write_archives
from quarry.session import shared_dir

PAGES = "page_id long, url string, html string"


def round_trip(spark, rows, select=None):
    folder = shared_dir(spark, "warc-test")
    index = write_archives(spark.createDataFrame(rows, PAGES).withColumn("digest", F.lit("clash")), folder)
    return index, folder, read_records(index if select is None else index.where(select), folder).collect()


def test_payloads_come_back_and_copies_revisit(spark):
    big, small = "é" * 80, "tiny"
    rows = [(k, f"http://h/{k}", big) for k in range(5, 45)] + [(50, None, None), (51, "http://h/a b\r\nX: y", small), (52, "u", small), (5, "again", big), (None, "n", big), (60, "l", "x" * 3_000_000)]
    index, folder, got = round_trip(spark, rows)
    assert len(got) == len(rows)
    by = {r.url: r for r in got}
    assert by["http://h/5"].payload.decode() == big and by["http://h/5"].record_type == "response"
    assert all(by[f"http://h/{k}"].refers_to == 5 and by[f"http://h/{k}"].record_type == "revisit" and by[f"http://h/{k}"].payload_bytes == 160 for k in range(6, 45))
    assert by["again"].record_type == "response" and by["n"].refers_to == 5
    assert by["http://h/a%20b%0D%0AX:%20y"].payload == b"tiny" and by["u"].record_type == "response"
    assert by[""].payload == b"" and by["l"].payload_bytes == 3_000_000
    assert all(r.payload_digest == hashlib.sha256((h or "").encode()).hexdigest() for r in got for p, u, h in rows if p == r.page_id and h != big)


def test_selected_records_by_range(spark):
    rows = [(k, f"u{k}", f"page {k} " * 40) for k in range(200)]
    index, folder, got = round_trip(spark, rows, "page_id % 7 = 3")
    assert sorted((r.page_id, r.payload.decode()) for r in got) == [(k, f"page {k} " * 40) for k in range(200) if k % 7 == 3]
    first = index.orderBy("file", "offset").first()
    from pyarrow import fs

    system, base = fs.FileSystem.from_uri(folder)
    with system.open_input_file(f"{base}/{first.file}") as f:
        assert parse_record(gzip.decompress(f.read_at(first.length, first.offset)))["warc-target-uri"] == first.url


def test_no_pages(spark):
    assert round_trip(spark, [])[2] == []


def chats(spark, rows):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("seq", F.lit(9)).withColumn("loss", F.lit("clash"))
    return {r.conv_id: r for r in read_back(format_conversations(df)).collect()}


def digest(turns):
    return hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()


def test_escapes_are_reversible():
    for text in ("", "<|", "<\\|", "<\\\\|x<|", PROBE, "a<", "|<\\", "<<||", "\\n\n<|im_end|>"):
        assert unescape(escape(text)) == text and "<|" not in escape(text)
        assert unescape_role(escape_role(text)) == text and "\n" not in escape_role(text)


def test_digests_masks_and_turn_order(spark):
    rows = [
        (1, 0, "system", "s"), (1, 1, "user", PROBE), (1, 2, "assistant", "é<\\|"), (1, 3, "user", "u"), (1, 4, "assistant", PROBE),
        (2, 1, "assistant", "a"), (2, 0, "user", "q"), (3, 0, "user", None), (4, 0, None, "x"), (5, 0, "user", "b"), (5, 0, "user", "a"), (5, 0, "user", "a"),
        (None, 0, "user", "n"), (None, 1, "assistant", "m" * 2_000_000), (6, None, "a\n<|im_end|>", "t"),
    ]
    got = chats(spark, rows)
    assert got[1].turns_sha256 == digest([("system", "s"), ("user", PROBE), ("assistant", "é<\\|"), ("user", "u"), ("assistant", PROBE)])
    assert got[1].loss_chars == 4 + len(PROBE) and got[1].loss_sha256 == hashlib.sha256(("é<\\|" + PROBE).encode()).hexdigest()
    assert got[1].valid and got[2].valid and not got[3].valid and not got[4].valid and not got[5].valid
    assert got[3].turns_sha256 == digest([("user", "")]) and got[4].turns_sha256 == digest([("", "x")])
    assert got[5].n_turns == 3 and got[5].turns_sha256 == digest([("user", "a"), ("user", "a"), ("user", "b")])
    assert got[None].valid and got[None].loss_chars == 2_000_000
    assert got[6].turns_sha256 == digest([("a\n<|im_end|>", "t")])
    marks = len(CHATML.open + CHATML.after_role + CHATML.close)
    assert got[2].formatted_chars == 2 * marks + len("user" + "q" + "assistant" + "a")


def test_no_conversations(spark):
    assert chats(spark, []) == {}
