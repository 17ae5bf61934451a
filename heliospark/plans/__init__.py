"""The three end-to-end jobs: clean build, training, and scoring with forecast."""
