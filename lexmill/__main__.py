"""[OR-06] Command line.

python -m lexmill QUERY SF_DIR [--out PATH]             run a registered query
python -m lexmill clean STORE FOLDER                    the governed stages over a store
python -m lexmill discover RECORDS FOLDER --store STORE new names of records into the folder's queue
python -m lexmill audit RECORDS FOLDER [--store STORE]  every occurrence of every name
python -m lexmill review STORE FOLDER                   ready entries with their default action
python -m lexmill apply STORE FOLDER                    the decisions of the folder's review
"""

from __future__ import annotations

import argparse


def settings_of(spark, args):
    """Settings of a clean run; models are looked up before anything runs."""
    from functools import partial

    from lexmill.plans.pipeline import Settings, model_arbiter, model_classifier, reply_arbiter, reply_classifier
    from lexmill.sources import providers

    made = Settings(threshold=args.similarity, most_cluster=args.cluster_size)
    if args.chat_url:
        chat = partial(providers.http_chat, args.chat_url, args.chat_model, timeout=args.timeout)
        providers.verify(args.chat_url, args.chat_model, lambda: chat()("Say ok."), timeout=args.timeout)
        made.arbiter, made.classifier = (f(chat, f"{args.chat_url}|{args.chat_model}") for f in (model_arbiter, model_classifier))
    if args.cluster_replies:
        made.arbiter = reply_arbiter(spark.read.schema("cluster_id string, reply string").json(args.cluster_replies))
    if args.class_replies:
        made.classifier = reply_classifier(spark.read.schema("term string, reply string").json(args.class_replies))
    if args.embedding_url:
        embed = partial(providers.http_embedder, args.embedding_url, args.embedding_model, timeout=args.timeout)
        providers.verify(args.embedding_url, args.embedding_model, lambda: embed()(["ok"]), timeout=args.timeout)

        def embedder(names):
            return providers.embedded(names, "term", embed, args.embedding_batch)

        embedder.mark = f"model|{args.embedding_url}|{args.embedding_model}"
        made.embedder = embedder
    return made


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="lexmill", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    parser.add_argument("what", help="a query name, or clean, discover, audit, review, apply")
    parser.add_argument("source", help="folder of tables, store file, or record lines")
    parser.add_argument("folder", nargs="?", help="folder that is worked in")
    parser.add_argument("--store", help="store file of discover and audit")
    parser.add_argument("--pairs", help="block list of clean, a JSON object")
    parser.add_argument("--exceptions", help="exceptions file of clean")
    parser.add_argument("--threshold", type=int, default=5, help="sightings that make a queue entry ready")
    parser.add_argument("--out", help="write the rows as Parquet instead of showing some")
    parser.add_argument("--last", type=int, default=6, help="last stage of clean")
    parser.add_argument("--only", type=int, help="the one stage of clean to run, on a folder that has those before it")
    parser.add_argument("--similarity", type=float, default=0.85, help="least similarity of an edge of clean")
    parser.add_argument("--cluster-size", type=int, default=10, help="most terms of a cluster of clean")
    parser.add_argument("--cluster-replies", help="JSON lines (cluster_id, reply) that decide clusters")
    parser.add_argument("--class-replies", help="JSON lines (term, reply) that classify terms")
    parser.add_argument("--chat-url", help="server of the model that decides and classifies where no replies are given")
    parser.add_argument("--chat-model", help="its name")
    parser.add_argument("--embedding-url", help="server of the embedding model; without one trigrams give the edges")
    parser.add_argument("--embedding-model", help="its name")
    parser.add_argument("--embedding-batch", type=int, default=64, help="texts of an embedding request")
    parser.add_argument("--timeout", type=float, default=120.0, help="seconds for a model's answer")
    args = parser.parse_args(argv)
    from pyspark.sql import SparkSession

    from lexmill import registry
    from lexmill.plans.pipeline import Run
    from lexmill.plans.queue import Discovery
    from lexmill.sources.stores import read_exceptions, read_pairs, read_store

    spark = SparkSession.builder.appName("lexmill").getOrCreate()
    if args.what in ("clean", "discover", "audit", "review", "apply") and not args.folder:
        parser.error(f"{args.what} needs a folder")
    if args.what in ("discover", "audit", "review", "apply"):
        steps = Discovery(spark, args.folder, args.threshold)
        if args.what == "discover":
            if not args.store:
                parser.error("discover needs --store")
            print(steps.discover(args.source, read_store(spark, args.store)))
        elif args.what == "audit":
            print(steps.audit(args.source, read_store(spark, args.store) if args.store else None))
        elif args.what == "review":
            steps.review(read_store(spark, args.source)).show(50, truncate=80)
        else:
            print(steps.apply())
        return 0
    if args.what == "clean":
        pairs = read_pairs(spark, args.pairs) if args.pairs else None
        exceptions = read_exceptions(spark, args.exceptions) if args.exceptions else None
        run = Run(spark, read_store(spark, args.source), args.folder, settings_of(spark, args), pairs=pairs, exceptions=exceptions)
        if args.only is not None:
            run.only(args.only)
            return 0
        run.run(args.last)
        if args.last < 6:
            return 0
        print(run.markdown())
        return run.exit_code()
    made = registry.queries()
    if args.what not in made:
        parser.error(f"no query {args.what}; there are {', '.join(sorted(made))}")
    df = made[args.what](spark, args.source)
    if args.out:
        df.write.mode("overwrite").parquet(args.out)
    else:
        df.show(50, truncate=80)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
