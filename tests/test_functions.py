import base64
import itertools
import random

import pytest
from pyspark.sql import functions as F

from docengine.functions import predicates, settings, text
from docengine.operators import assets, options
from docengine.sources import sink


def column(spark, expr, rows, schema):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expr).collect()]


def test_suffixes(spark):
    rows = [("a.pdf",), (".pdf",), ("x.tar.gz",), ("d/e.f/g",), ("none",), ("http://h/a.HTML",)]
    assert column(spark, text.suffix(F.col("f")), rows, "f string") == [".pdf", "", ".gz", "", "", ".HTML"]
    assert column(spark, text.suffix_or_default(F.col("f")), rows, "f string")[4] == ".pdf"
    assert column(spark, text.output_path(F.col("f")), rows[:3], "f string") == ["a.md", ".pdf.md", "x.tar.md"]


def test_base64(spark):
    raw = bytes(range(256)) * 3
    assert column(spark, text.encode64(F.col("b")), [(raw,)], "b binary") == [base64.b64encode(raw).decode()]
    rows = [(base64.b64encode(b"hello").decode(),), ("SGV!sbG8=",), ("!!!not-valid-base64!!!",), ("",), ("SGVsbG8",), (None,)]
    assert [None if x is None else bytes(x) for x in column(spark, text.decode64(F.col("t")), rows, "t string")] == [b"hello", b"Hello", None, b"", None, None]


def lenient(text):
    try:
        return base64.b64decode(text)
    except ValueError:
        return None


def test_base64_is_read_as_a_lenient_decoder_reads_it(spark):
    """Every text of up to five of these signs, and random longer ones."""
    texts = ["".join(t) for n in range(6) for t in itertools.product("Qx=!", repeat=n)]
    r = random.Random(4)
    texts += ["".join(r.choices("QUJDx=-_ \n", [6, 6, 6, 6, 6, 2, 1, 1, 1, 1], k=r.randint(0, 40))) for _ in range(3000)]
    texts += ["QUJD" * 50_000 + "QQ==", "QUJDé", "QQ==QUJD", "Q=Q=", "QUI=QUI="]
    got = column(spark, text.decode64(F.col("t")), [(t,) for t in texts], "t string")
    assert [None if x is None else bytes(x) for x in got] == [lenient(t) for t in texts]


def test_devices_and_precision(spark):
    rows = [("cpu",), ("AMD ",), ("rocm",), ("auto",), ("",), (None,)]
    assert column(spark, settings.device(F.col("d")), rows, "d string") == ["cpu", "cuda", "cuda", "__auto__", None, None]
    with pytest.raises(Exception, match="amd, auto, cpu, cuda, mps, nvidia, rocm"):
        column(spark, settings.device(F.col("d")), [("directml",)], "d string")
    with pytest.raises(Exception, match="bfloat16, float16, float32"):
        column(spark, settings.precision(F.col("d")), [("int8",)], "d string")


@pytest.mark.parametrize(
    "env,service",
    [({}, None), ({"OLLAMA_MODEL": "m"}, "ollama"), ({"OPENAI_MODEL": "m"}, None), ({"OPENAI_API_KEY": "k", "CLAUDE_API_KEY": "k"}, "openai"), ({"OLLAMA_BASE_URL": "u", "OPENAI_API_KEY": "k"}, "ollama"), ({"CLAUDE_API_KEY": "k"}, "claude"), ({"OLLAMA_MODEL": ""}, None), ({settings.SERVICE_KEY: "own", "OLLAMA_MODEL": "m"}, "own")],
)
def test_service_precedence(spark, env, service):
    rows = [({"-": "-", **env},)]
    (got,) = column(spark, settings.llm_options(F.col("e")), rows, "e map<string,string>")
    assert got == settings.llm_options_of(env)
    assert got.get("llm_service") == service


def test_options_omit_what_is_false(spark):
    o = column(spark, options.build_options(page_range="", max_pages_per_chunk=0), [(1,)], "x int")[0]
    assert (o.output_format, o.page_range, o.max_pages_per_chunk, o.force_ocr, o.use_llm) == ("markdown", None, 0, None, None)
    llm = F.create_map(F.lit("llm_service"), F.lit("ollama"), F.lit("ollama_model"), F.lit("m"), F.lit("x"), F.lit("y"))
    with_llm = options.build_options(use_llm=True, llm=llm, max_pages_per_chunk=3)
    o = column(spark, with_llm, [(1,)], "x int")[0]
    assert (o.use_llm, o.llm_service, o.extra) == (True, "ollama", {"ollama_model": "m", "x": "y"})
    o = column(spark, options.without_llm(options.without_chunking(with_llm)), [(1,)], "x int")[0]
    assert (o.use_llm, o.llm_service, o.max_pages_per_chunk, o.extra) == (None, None, None, {"x": "y"})
    assert column(spark, options.build_options(llm=llm), [(1,)], "x int")[0].extra is None
    assert column(spark, options.example_options(), [(1,)], "x int")[0].paginate_output is True


def test_failures(spark):
    rows = [("CUDA out of memory. Tried", "X"), ("x", "OutOfMemoryError"), ("x", "ValueError")]
    assert column(spark, predicates.is_out_of_memory(F.col("m"), F.col("k")), rows, "m string, k string") == [True, True, False]
    assert column(spark, predicates.is_llm_failure(F.col("m")), [("LLM down",), ("see google.pdf",), ("bad",)], "m string") == [True, True, False]


def test_assets(spark):
    rows = [('{"images": {}}',), ('{"a": ["x/path"]}',), ('{"a": "path"}',), ("{}",), ("plain",), (None,), ('{"k": 1}',)]
    assert column(spark, predicates.looks_like_assets(F.col("p")), rows, "p string") == [True, True, False, False, False, False, False]
    names = [("a/b.png",), ("a/../b",), ("../b",), ("a/../../b",), ("/b",), ("",), (None,), ("a/..",), ("c:\\b",)]
    want = [True, True, False, False, False, False, False, False, False]
    assert column(spark, assets.is_safe_name(F.col("n")), names, "n string") == [sink.safe_name(n) for (n,) in names] == want


def test_joins_and_pagination(spark):
    rows = [(["a", "", " ", "b"],), ([],)]
    assert column(spark, text.join_texts(F.col("t")), rows, "t array<string>") == ["a\n\n \n\nb", ""]
    assert column(spark, text.paginate(F.col("t")), [(["x", "y"],)], "t array<string>") == ["\n\n{0}" + "-" * 48 + "\n\nx\n\n{1}" + "-" * 48 + "\n\ny"]
