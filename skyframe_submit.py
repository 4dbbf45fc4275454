"""spark-submit entry point for the command line, e.g.

    zip -r skyframe.zip skyframe
    spark-submit --master yarn --py-files skyframe.zip \
        --conf spark.checkpoint.dir=hdfs:///shared/ckpt skyframe_submit.py clean --ods wx.ods --dwd wx.dwd
"""

import sys

from skyframe.__main__ import main

if __name__ == "__main__":
    sys.exit(main())
