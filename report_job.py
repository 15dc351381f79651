"""spark-submit entry point for the whole analysis (``epipanel.plans.report``)."""

from epipanel.plans.report import main

if __name__ == "__main__":
    main()
