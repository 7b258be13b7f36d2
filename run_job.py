"""Run one job; see ``ratewatch.cli``."""

from ratewatch.cli import main

if __name__ == "__main__":
    main()
