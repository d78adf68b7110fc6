"""Entry point for spark-submit: ``spark-submit run_job.py <job> ...``."""

from blockfee.cli import main

if __name__ == "__main__":
    main()
