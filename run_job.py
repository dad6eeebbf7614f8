"""Entry point for ``spark-submit``: ``run_job.py <job> --help`` lists each job's arguments."""

from ingotflow.plans.cli import main

if __name__ == "__main__":
    main()
