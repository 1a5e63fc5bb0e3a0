"""spark-submit claimforge/cli.py --config FILE --train PATH [--test PATH] [--scale NAME] [--output_dir DIR] [--resume]"""

from __future__ import annotations

import argparse

from claimforge.config import SCALES, Config, merge
from claimforge.plans import engine
from claimforge.session import session
from claimforge.sources import scene_graphs, sink


def main(argv: list[str] | None = None) -> engine.Run:
    p = argparse.ArgumentParser(description=__doc__)
    p.add_argument("--config")
    p.add_argument("--train")
    p.add_argument("--test")
    p.add_argument("--scale", choices=SCALES)
    p.add_argument("--output_dir")
    p.add_argument("--resume", action="store_true")
    args = p.parse_args(argv)
    raw = Config.load(args.config).raw
    over = {"scale": args.scale} if args.scale else {}
    over |= {"paths": {"output_dir": args.output_dir}} if args.output_dir else {}
    config = Config.load(merge(raw, over))
    spark = session()
    train = scene_graphs.read(spark, args.train or config.raw["paths"]["scene_graphs_train"])
    test = scene_graphs.read(spark, args.test) if args.test else None
    existing = sink.existing_keys(spark, config.output()) if args.resume else None
    result = engine.run(spark, config, train, test, existing, progress=print)
    engine.publish(spark, config, result)
    print({k: v for k, v in result.stats.items() if not isinstance(v, dict)})
    return result


if __name__ == "__main__":
    main()
