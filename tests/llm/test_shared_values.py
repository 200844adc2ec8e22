"""Workers that cannot import the package still run everything that is broadcast."""

import os
import subprocess
import sys
from pathlib import Path

CODE = """
import sys
sys.path.insert(0, {repo!r})  # of the driver alone
from pathlib import Path
import public_tokenizers
from pyspark.sql import SparkSession, functions as F
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2")
         .config("spark.ui.showConsoleProgress", "false").getOrCreate())

def absent(batches):
    import pyarrow as pa
    for batch in batches:
        try:
            import plumbline.session
            found = 1
        except ImportError:
            found = 0
        yield pa.RecordBatch.from_pydict({{"found": pa.array([found] * batch.num_rows, pa.int32())}})

assert spark.range(4).mapInArrow(absent, "found int").agg(F.sum("found")).first()[0] == 0
from plumbline.plans.families import family
from plumbline.plans.prepared import Prepared
from plumbline.operators.boosting import BoostSpec, fit_boosted
from plumbline.llm import alignment, bpe, decontamination, jaccard_join, lang_id, lm_scoring, quality, token_counts, vector_codes
rows = spark.range(400).select("id", (F.col("id") % 7).cast("double").alias("a"), (F.col("id") % 5 > 2).cast("int").alias("y"))
p = Prepared(rows, "y", ["id"])
for name, params in (("dt", {{"max_depth": 2}}), ("rf", {{"n_estimators": 2, "max_depth": 2}}), ("adaboost", {{"n_estimators": 2}})):
    family(name).fit_with_folds(p, params, "cv_fold")[0].predict(p.test).count()
p.grower("cv_fold", False).release()
fit_boosted(p.cells(), p.features, [BoostSpec(2)], p.edges, local_bytes=0)
docs = spark.createDataFrame([(i, f"some words number {{i % 3}} of a text", "en") for i in range(30)], "doc_id long, text string, lang string")
path = public_tokenizers.path
word, byte = (Path(path(f)).read_text(encoding="utf-8") for f in ("word_bpe_49k.json", "byte_bpe_50k.json"))
piece = Path(path("piece_bpe_32k.model")).read_bytes()
bpe.decode(bpe.encode(docs, word), word).collect()
lang_id.with_language(docs, lang_id.fit(docs)).collect()
token_counts.with_token_counts(docs, piece).collect()
decontamination.contamination(docs, docs.select(F.col("doc_id").alias("item_id"), "text").limit(3))[0].collect()
lm_scoring.score(docs, docs).collect()
jaccard_join.similar_components(docs).collect()
quality.with_scores(docs, quality.fit(docs, docs.select("doc_id", (F.col("doc_id") % 2).alias("quality")))).collect()
b = alignment.PieceTokens(piece)
aligned, new = alignment.align(docs, alignment.ByteTokens(byte), b)
alignment.with_count_sums(aligned, alignment.pair_counts(aligned, b.size, new[5]), b.size, new[5], new[6])[0].collect()
vectors = spark.range(90).select(F.col("id").alias("vec_id"), F.array(*[F.rand(i) for i in range(16)]).alias("embedding"), F.lit(1).alias("label"))
vector_codes.encode(vectors)[0].collect()
print("ALL RAN")
"""


def test_workers_need_no_copy_of_the_package(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    code = CODE.format(repo=str(Path(__file__).parent.parent.parent))
    run = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=400)
    assert "ALL RAN" in run.stdout, run.stderr[-3000:]
