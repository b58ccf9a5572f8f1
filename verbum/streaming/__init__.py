from verbum.streaming.score import read_scored, score_lines, start_scoring

__all__ = ["read_scored", "score_lines", "start_scoring"]
