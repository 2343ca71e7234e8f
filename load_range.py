"""spark-submit driver for one load run: see martlake.plans.runner.main."""

from martlake.plans.runner import main

if __name__ == "__main__":
    main()
