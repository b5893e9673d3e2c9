"""``spark-submit --py-files kerbside.zip run_job.py JOB ...``; see kerbside/jobs.py."""

from kerbside.jobs import main

if __name__ == "__main__":
    main()
