import hashlib
import random

import pytest

from ratewatch.llm import pieces
from ratewatch.llm.queries import QUERIES, tokenizer_path

spm = pytest.importorskip("sentencepiece")
PARTS = ["a", "b", "e", " ", " ", "\n", "\t", "▁", "▁▁", "é", "é", "①", "ﬁ", "漢", "😀", "‍", "Ⅷ", "\x00"]
PARTS += ["<0x0A>", "</s>", "<s>", "<unk>", "  ", "   ", "the ", "ing", "カ", "ﾞ", "　", "­"]


def model():
    with open(tokenizer_path("piece_bpe_32k.model"), "rb") as file:
        return file.read()


def mapped(rule, strip, suffix=False):
    """The model with one of the library's own character maps."""
    proto = spm.sentencepiece_model_pb2.ModelProto.FromString(model())
    blob = spm.SentencePieceNormalizer(rule_name=rule).serialized_normalizer_spec()
    spec = spm.sentencepiece_model_pb2.NormalizerSpec.FromString(blob)
    spec.add_dummy_prefix = spec.escape_whitespaces = True
    spec.remove_extra_whitespaces = strip
    proto.normalizer_spec.CopyFrom(spec)
    proto.trainer_spec.treat_whitespace_as_suffix = suffix
    return proto.SerializeToString()


def texts(n=800, seed=3):
    rng = random.Random(seed)
    made = ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 30))) for _ in range(n)]
    return [*made, "", " ", "   ", "x", "▁", "no space here" * 50]


@pytest.mark.parametrize(
    "blob",
    [
        pytest.param(model, id="identity"),
        pytest.param(lambda: mapped("nmt_nfkc", True), id="nmt_nfkc"),
        pytest.param(lambda: mapped("nmt_nfkc", False), id="nmt_nfkc, spaces kept"),
        pytest.param(lambda: mapped("nfkc_cf", True, True), id="nfkc_cf, space behind"),
    ],
)
def test_ids_and_spans_are_the_library_s(blob):
    raw = blob()
    library = spm.SentencePieceProcessor(model_proto=raw)
    offsets, ids, starts, ends = pieces.Encoder(raw).encode(texts())
    for k, text in enumerate(texts()):
        own = slice(offsets[k], offsets[k + 1] - 1)
        found = list(zip(ids[own].tolist(), starts[own].tolist(), ends[own].tolist(), strict=True))
        assert found == [(p.id, p.begin, p.end) for p in library.encode(text, return_type="proto").pieces], repr(text)
        assert ids[offsets[k + 1] - 1] == library.eos_id()


def test_other_models_are_refused():
    proto = spm.sentencepiece_model_pb2.ModelProto.FromString(model())
    proto.trainer_spec.byte_fallback = False
    with pytest.raises(ValueError, match="byte fallback"):
        pieces.Encoder(proto.SerializeToString())


def test_documents(spark, make_docs, prose):
    path = tokenizer_path("piece_bpe_32k.model")
    library = spm.SentencePieceProcessor(model_file=path)
    given = {1: "Hello  wörld\n", 2: None, 3: "", 4: prose(4, 30_000), 5: "x" * 20_000, None: "漢 ①", 7: "Hello  wörld\n"}
    docs = make_docs(*given.items(), (1, given[1])).withColumnRenamed("lang", "ids")
    rows = pieces.encoded(docs, path).collect()
    assert len(rows) == len(given) + 1
    for row in rows:
        text = given[row.doc_id] or ""
        assert row.ids == library.encode(text, add_eos=True)
        assert row.decoded == library.decode(row.ids) == text
        covered = b"".join(text.encode()[a:b] for a, b in zip(row.starts, row.ends, strict=True))
        assert covered == text.encode()
    assert pieces.encoded(make_docs(), path).count() == 0


def test_query(spark, sf):
    library = spm.SentencePieceProcessor(model_file=tokenizer_path("piece_bpe_32k.model"))
    given = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = QUERIES["op12_piece_spans"](spark, sf).collect()
    assert {r.doc_id for r in rows} == set(given)
    for row in rows:
        ids = library.encode(given[row.doc_id], add_eos=True)
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()
