"""Entry point for ``spark-submit``; see ``gridpulse/__main__.py``."""

from gridpulse.__main__ import main

if __name__ == "__main__":
    main()
