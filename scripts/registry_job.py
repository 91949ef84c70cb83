"""Launcher for spark-submit: ``spark-submit --py-files tabletally.zip scripts/registry_job.py ARGS``."""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tabletally.job import main  # noqa: E402

if __name__ == "__main__":
    sys.exit(main())
