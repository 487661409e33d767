"""spark-submit --py-files riskloom.zip jobs/close_day.py --payments … --visits … --target … --date …"""

import argparse
import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from riskloom.plans.nightly_close import nightly_close  # noqa: E402
from riskloom.session import build_session  # noqa: E402


def main() -> None:
    parser = argparse.ArgumentParser()
    parser.add_argument("--payments", required=True, help="folder or pattern of JSON lines")
    parser.add_argument("--visits", required=True, help="folder or pattern of framed JSON lines")
    parser.add_argument("--target", required=True, help="folder of tables and reports")
    parser.add_argument("--date", required=True, help="batch date, yyyy-MM-dd")
    parser.add_argument("--clean", choices=["archive", "delete"], help="what becomes of landed files")
    parser.add_argument("--archive", help="folder of archived files")
    given = parser.parse_args()
    spark = build_session("close day")
    counts = nightly_close(
        spark, given.payments, given.visits, given.target, given.date, given.clean, given.archive
    )
    print("nothing has arrived" if counts is None else counts)


if __name__ == "__main__":
    main()
