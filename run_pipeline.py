"""spark-submit entry point for the batch pipeline job (``lakemart.pipeline``).

    zip -r lakemart.zip lakemart
    spark-submit --py-files lakemart.zip run_pipeline.py --csv 's3://bucket/raw/*.csv' --out s3://bucket/lake
"""

from lakemart.pipeline import main

if __name__ == "__main__":
    main()
