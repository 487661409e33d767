"""spark-submit --packages <Kafka connector> jobs/score_streams.py --servers … --target … --blacklist …"""

import argparse
import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from riskloom.plans.speed_layer import run  # noqa: E402
from riskloom.session import build_session  # noqa: E402


def main() -> None:
    parser = argparse.ArgumentParser()
    parser.add_argument("--servers", required=True, help="Kafka bootstrap servers")
    parser.add_argument("--target", required=True, help="folder of tables and checkpoints")
    parser.add_argument("--blacklist", required=True, help="CSV of addresses")
    parser.add_argument("--max-offsets", type=int, help="records per micro-batch")
    given = parser.parse_args()
    run(
        build_session("score streams"), given.servers, given.target, given.blacklist,
        max_offsets=given.max_offsets,
    )


if __name__ == "__main__":
    main()
