"""spark-submit launcher for the batch job (E1 + E2).

    spark-submit --py-files pricelens.zip run_pipeline.py <raw_dir> <out_base> [--format json]
"""

import sys

from pricelens.plans.pipeline import main

if __name__ == "__main__":
    sys.exit(main())
