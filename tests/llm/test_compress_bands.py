import random
import re
from collections import Counter

import zstandard
from hypothesis import given, settings
from hypothesis import strategies as st

from matchspark.llm.compress_bands import BASE, Bands, compression_bands, repeated_words, text_measures

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, kept string, n_words string"


def brute(text):
    words = WORD.findall(text or "")
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    times = Counter(windows)
    inside = {i + k for i, w in enumerate(windows) if times[w] > 1 for k in range(3)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    failed = len(words) < 50 or 100 * len(inside) > 50 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(inside), failed


def brute_verdict(text, bands=Bands()):
    """Kept or not, by compressing the whole and every chunk."""
    data = (text or "").encode()

    def ratio(part):
        return len(part) / len(zstandard.ZstdCompressor(level=bands.level, write_content_size=False, write_checksum=False).compress(part))

    if brute(text)[5]:
        return False
    edge = sum(len(data) > e for e in bands.edges)
    low, high = bands.limits[edge][1:]
    chunks = [ratio(data[i : i + bands.chunk]) for i in range(0, len(data), bands.chunk) if i + bands.chunk <= len(data)]
    if len(data) > bands.chunk and len(data) % bands.chunk:
        chunks.append(ratio(data[-bands.chunk :]))
    if chunks and not (bands.worst[0] <= min(chunks) and max(chunks) <= bands.worst[1]):
        return False
    outside = [c for c in chunks if not bands.chunk_limits[0] <= c <= bands.chunk_limits[1]]
    return low <= ratio(data) <= high and len(outside) <= bands.share * len(chunks)


def prose(rng, n):
    return " ".join("".join(rng.choice("aeiourstnlm") for _ in range(rng.randint(2, 9))) for _ in range(n))


def test_base_columns_and_verdicts(spark):
    rng = random.Random(1)
    clean = prose(rng, 700)
    noise = " ".join("".join(chr(rng.randint(0x4E00, 0x9FFF)) for _ in range(6)) for _ in range(400))
    steps = " ".join(f"{prose(rng, 1)} in the same old" for _ in range(300))
    texts = [
        None, "", " \t\n", "one", clean, noise, steps, "w " * 400, "a b c\n" * 60, " x y " * 60, "a\x0bb\x0cc\rd\n" * 20,
        "#*$%&|<> " * 60, prose(rng, 30_000), prose(rng, 60) + "\n\n \n\n" + prose(rng, 5), "x" * 200_000,
    ]
    df = spark.createDataFrame([(i, t, "k", "n") for i, t in enumerate(texts)] + [(4, clean, None, None)], SCHEMA)
    got = compression_bands(df, keep_text=False).collect()
    assert len(got) == len(texts) + 1
    for r in got:
        assert tuple(r[name] for name, _ in BASE) == brute(texts[r.doc_id])
        assert r.kept == brute_verdict(texts[r.doc_id])
    kept = {r.doc_id for r in got if r.kept}
    assert {4} <= kept and not kept & {0, 1, 2, 3, 6, 7, 8, 14}
    assert compression_bands(df.limit(0)).count() == 0


def test_a_passage_counts_wherever_it_lies(spark):
    """The same two kilobytes of noise or repetition reject a text at its start and at its end; between, by the chunks they lie in."""
    rng = random.Random(3)
    rows, ends, clean_ids = [], set(), set()
    for n in (1200, 1500, 3000):
        clean = prose(rng, n)
        clean_ids.add(len(rows))
        rows.append((len(rows), clean, "", ""))
        for bad in ("lorem ipsum dolor " * 114, "".join(chr(rng.randint(0x21, 0x7E)) for _ in range(2048))):
            for at in (0, len(clean) // 2, len(clean)):
                if at != len(clean) // 2:
                    ends.add(len(rows))
                rows.append((len(rows), clean[:at] + bad[:2048] + clean[at:], "", ""))
    got = {r.doc_id: r for r in compression_bands(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert all(got[r[0]].kept == brute_verdict(r[1]) for r in rows)
    kept = {i for i, r in got.items() if r.kept}
    assert clean_ids <= kept and not kept & ends and len(ends) == 12


def test_text_stays_on_request(spark):
    df = spark.createDataFrame([(1, "t", "k", "n")], SCHEMA)
    assert compression_bands(df).columns[:2] == ["doc_id", "text"]


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab \n\t|é", max_size=60))
def test_any_text_equals_brute_force(text):
    assert text_measures(text, Bands(), lambda b: len(b) or 1)[:6] == brute(text)


def test_repeats_of_windows_that_only_share_a_key(monkeypatch):
    monkeypatch.setattr("builtins.hash", lambda w: 7)
    assert repeated_words([b"a", b"b", b"c", b"d", b"e"]) == 0
    assert repeated_words([b"a", b"b", b"c", b"x", b"a", b"b", b"c"]) == 6
