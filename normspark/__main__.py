"""python -m normspark COMMAND: the stages from raw tables to graph tables, and the reports, from the command line."""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from normspark import schemas as S
from normspark.operators import debug, extract, graph, quality
from normspark.plans import pipeline
from normspark.session import session
from normspark.sources import files

NODES = ("norms", "components", "text_units", "actions", "cache_units", "relations")


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="normspark", description=__doc__)
    s = p.add_subparsers(dest="command", required=True)
    for name, about in (("extract", "fetch all raw tables anew"), ("download", "fetch raw tables that are not there"), ("explain", "why sentences of one document resolve in another, or don't"), ("retry", "embed the units of an error log again"), ("keyword", "tables of the documents with a keyword in the title"), ("sample", "the first documents with page and relations, as JSON"), ("transform", "raw tables to node tables"), ("embed", "vectors for text units that lack one"), ("load", "edge tables of the graph"), ("all", "transform, embed, load"), ("report", "quality report of the text units"), ("estimate", "size of the graph against a budget"), ("check", "which tables are there, with their rows"), ("clean", "remove an output folder")):
        c = s.add_parser(name, help=about)
        c.add_argument("--input-dir", default="data/raw")
        c.add_argument("--output-dir", default="data/out")
        if name in ("extract", "download"):
            c.add_argument("--source", required=True, help="folder with a folder of shards for each table")
            c.add_argument("--configs", nargs="+", default=list(files.CONFIGS))
            c.add_argument("--force", action="store_true")
        if name == "explain":
            c.add_argument("--id-a", required=True)
            c.add_argument("--id-b", required=True)
        if name == "retry":
            c.add_argument("--errors-file", help="default: the log beside the vectors")
        if name == "report":
            c.add_argument("--sample", type=int)
            c.add_argument("--out", help="write the report as JSON lines instead of printing it")
        if name in ("load", "all"):
            c.add_argument("--max-nodes", type=int, help="keep the graph within so many nodes")
            c.add_argument("--max-edges", type=int, help="and so many edges")
        if name == "keyword":
            c.add_argument("--keywords-file", required=True)
            c.add_argument("--limit", type=int)
        if name == "sample":
            c.add_argument("--n", type=int, default=100)
        if name in ("transform", "all"):
            c.add_argument("--sample", type=int)
        if name == "estimate":
            c.add_argument("--max-nodes", type=int, default=200_000)
            c.add_argument("--max-edges", type=int, default=400_000)
        if name == "clean":
            c.add_argument("--force", action="store_true")
    return p


def _read(spark: SparkSession, folder: str, names: tuple[str, ...]) -> dict:
    return {n: spark.read.parquet(f"{folder}/{n}") for n in names}


def transform(spark: SparkSession, a) -> None:
    t = files.load_local(spark, a.input_dir)
    files.write_all(pipeline.transform(t["metadata"], t["content"], t["relationships"], sample=a.sample), a.output_dir)
    u, acts = spark.read.parquet(f"{a.output_dir}/text_units"), spark.read.parquet(f"{a.output_dir}/actions")
    files.write_jsonl(u.select("unit_id", "comp_id"), f"{a.output_dir}/component_textunit_map")
    files.write_jsonl(acts.select("action_id", "comp_a_id", "comp_b_id", "cache_unit_id"), f"{a.output_dir}/action_links")


def embed(spark: SparkSession, a) -> None:
    u = spark.read.parquet(f"{a.output_dir}/text_units").withColumn("embedding", F.lit(None).cast("array<float>")).withColumn("error_log", F.lit(None).cast("string"))
    done = f"{a.output_dir}/embedded"
    if files.exists(spark, done):  # a run that was broken off goes on where it stopped
        from normspark.operators import vector

        u = vector.with_embeddings(u, spark.read.parquet(done).filter("embedding is not null"))
    from normspark.session import cut

    got = cut(pipeline.embed(u), "embedded")
    files.ingest(got, done, force=True)
    failed = got.filter("error_log is not null").select("unit_id", F.col("error_log").alias("error"), F.current_timestamp().alias("timestamp"))
    files.write_jsonl(failed, f"{a.output_dir}/embed_errors", append=True)


def retry(spark: SparkSession, a) -> None:
    """Units of the error log lose their error and are embedded again, the others stay."""
    log = a.errors_file or f"{a.output_dir}/embed_errors"
    ids = files.read_jsonl(spark, log, S.EMBED_ERROR, strict=False).select("unit_id").distinct().withColumn("_again", F.lit(True))
    from normspark.session import cut

    u = spark.read.parquet(f"{a.output_dir}/embedded").join(ids, "unit_id", "left")
    u = u.withColumn("error_log", F.when(F.col("_again").isNull(), F.col("error_log"))).drop("_again")
    files.ingest(cut(pipeline.embed(u), "embedded"), f"{a.output_dir}/embedded", force=True)
    files.wipe(spark, log)


def load(spark: SparkSession, a) -> None:
    """Edges, of the embedded units where there are any; within a budget also the nodes that are left, as ``load_*``."""
    t = _read(spark, a.output_dir, NODES)
    t["text_units"] = files.prefer(spark, f"{a.output_dir}/embedded", f"{a.output_dir}/text_units")
    if a.max_nodes is None and a.max_edges is None:
        files.write_all(pipeline.load(t), a.output_dir)
        return
    keys = {"norms": "norm_id", "components": "comp_id", "text_units": "unit_id", "cache_units": "unit_id", "actions": "action_id"}
    kept = graph.budgeted({n: (t[n], [k]) for n, k in keys.items()}, S.MAX_NODES if a.max_nodes is None else a.max_nodes)
    ids = None
    for n, k in keys.items():
        one = kept[n].select(F.col(k).alias("id"))
        ids = one if ids is None else ids.unionByName(one)
    edges = graph.budgeted_edges(pipeline.load(t | kept), ids, S.MAX_EDGES if a.max_edges is None else a.max_edges)
    files.write_all({f"load_{n}": df for n, df in kept.items()} | edges, a.output_dir)


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    a = parser().parse_args(argv)
    spark = spark or session()
    if a.command == "keyword":
        t = files.load_local(spark, a.input_dir)
        got = extract.filtered(t["metadata"], t["content"], t["relationships"], files.keywords(spark, a.keywords_file), a.limit)
        for n, df in got.items():
            df.write.mode("overwrite").parquet(f"{a.output_dir}/{n}.parquet")
        print(json.dumps({n: spark.read.parquet(f"{a.output_dir}/{n}.parquet").count() for n in got}))
    elif a.command == "sample":
        t = files.load_local(spark, a.input_dir)
        m = t["metadata"].orderBy("id").limit(a.n)
        d = extract.sample(m, t["content"], a.n)
        r = extract.attached(t["relationships"], m.select("id")).groupBy("owner").agg(F.collect_list(F.struct("other_doc_id", "relationship", "direction")).alias("relationships"))
        files.write_jsonl(d.join(r, d["id"].cast("string") == r["owner"], "left").drop("owner"), f"{a.output_dir}/sample")
        files.write_keyed(d, "id", f"{a.output_dir}/sample_document")
    elif a.command in ("extract", "download"):
        print(json.dumps(files.download(spark, a.source, a.input_dir, tuple(a.configs), a.force or a.command == "extract")))
    elif a.command == "explain":
        t = _read(spark, a.output_dir, ("text_units", "component_index"))
        for r in debug.explained(t["text_units"], t["component_index"], a.id_a, a.id_b).orderBy("comp_id").toLocalIterator():
            print(json.dumps(r.asDict(), ensure_ascii=False))
    elif a.command == "retry":
        retry(spark, a)
    elif a.command == "transform":
        transform(spark, a)
    elif a.command == "embed":
        embed(spark, a)
    elif a.command == "load":
        load(spark, a)
    elif a.command == "all":
        transform(spark, a)
        embed(spark, a)
        load(spark, a)
    elif a.command == "report":
        r = quality.report(quality.sampled(spark.read.parquet(f"{a.output_dir}/text_units"), a.sample))
        f = quality.fallbacks(spark.read.parquet(f"{a.output_dir}/components"))
        f = f.select(F.lit("fallback").alias("section"), F.when(F.col("flagged"), "too many").otherwise("citations").alias("metric"), F.col("fallback").alias("value"), "pct")
        r = r.unionByName(f).orderBy("section", F.desc("value"))
        if a.out:
            files.write_jsonl(r.coalesce(1), a.out)
        else:
            for x in r.collect():  # some forty rows
                print(f"{x['section']:8} {x['metric']:20} {x['value']:10} {x['pct']:6} %")
    elif a.command == "estimate":
        n = {k: v.count() for k, v in _read(spark, a.output_dir, NODES).items()}
        size = graph.sizes(n["norms"], n["components"], n["text_units"], n["cache_units"], n["actions"], n["actions"], n["relations"])
        print(json.dumps(size | {"fits": size["nodes"] <= a.max_nodes and size["edges"] <= a.max_edges}))
        return int(size["nodes"] > a.max_nodes or size["edges"] > a.max_edges)
    elif a.command == "check":
        rows = debug.tables_present(spark, a.input_dir, list(files.CONFIGS)).collect()
        for r in rows:
            print(f"{r['name']:15} {'ok' if r['present'] else 'missing'} {r['rows'] if r['present'] else ''}")
        return int(not all(r["present"] for r in rows))
    elif a.command == "clean":
        if not a.force:
            print("nothing removed without --force")
            return 1
        files.wipe(spark, a.output_dir)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
