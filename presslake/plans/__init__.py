"""What a user calls: reports and the stages of a crawl run, built from the operators."""
