"""spark-submit entry: panel_job.py {panel,statistics,charts} --out PATH [...]"""

import sys

from panelspark.plans.jobs import main

if __name__ == "__main__":
    main(sys.argv[1:])
