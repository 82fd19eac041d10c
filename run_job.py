"""Run one of the jobs: ``spark-submit run_job.py --annotation_tool vep --tool_cmd '...' -i in.vcf -o out``."""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from varframe.plans.jobs import main  # noqa: E402

if __name__ == "__main__":
    main()
