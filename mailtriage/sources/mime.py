"""Reading one MIME message inside a task: headers and text parts, nothing else."""

from __future__ import annotations

from email import policy
from email.parser import BytesParser
from email.utils import parseaddr

_TEXT = {"text/plain": False, "text/html": True}


def _text_parts(mail):
    best = mail.get_body(preferencelist=("plain", "html"))
    if best is not None:
        return [best]
    if not mail.is_multipart():
        return [mail]
    return [part for part in mail.walk()
            if part.get_content_type() in _TEXT and not part.is_attachment()]


def read_message(content: bytes) -> dict:
    """subject, sender_email, parts [(is_html, text)]; on failure only the raw text."""
    row = {"raw": None, "subject": None, "sender_email": None, "parts": None}
    try:
        mail = BytesParser(policy=policy.default).parsebytes(content)
        parts = [{"html": _TEXT.get(p.get_content_type(), False), "text": str(p.get_content())}
                 for p in _text_parts(mail)]
        row |= {"subject": str(mail.get("Subject", "")), "parts": parts,
                "sender_email": parseaddr(str(mail.get("From", "")))[1]}
    except Exception:  # whatever a broken mail raises, the fallback patterns take over
        row["raw"] = content.decode("utf-8", errors="ignore")
    return row
