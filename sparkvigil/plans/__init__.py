"""Plan building blocks that keep jobs balanced when one key holds much of the data."""
