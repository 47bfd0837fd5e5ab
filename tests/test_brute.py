"""Whole small tables against a separate reading of the rules, row by row."""

import datetime as D
import os
import re
from zoneinfo import ZoneInfo

import pytest

from tracewell.functions import money
from tracewell.plans import problems

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables here")

M={m:i for i,m in enumerate("jan feb mar apr may jun jul aug sep oct nov dec".split(),1)}
AB=dict(utc=0,gmt=0,z=0,bst=60,est=-300,edt=-240,aest=600,aedt=660)
def _parse(s, hint):
    if s is None: return None
    s=s.strip().strip(' ').lower()
    m=re.fullmatch(r'(-?\d+)(\.0+)?',s)
    if m and not re.fullmatch(r'\d{14}',s):
        v=int(m[1]); a=abs(v)
        return v*10**6 if a<10**11 else v*1000 if a<10**14 else v
    m=re.fullmatch(r'(\d{4})(\d\d)(\d\d)(\d\d)(\d\d)(\d\d)',s); z=None; ap=None; f=''
    if m: y,mo,d,h,mi,se=m.groups()
    else:
        m=re.fullmatch(r'(\d{4})-(\d\d)-(\d\d)(?:[t ](\d\d):(\d\d)(?::(\d\d)(?:\.(\d+))?)?)?\s*(.*)',s)
        if m: y,mo,d,h,mi,se,f,z=m.groups()
        else:
            m=re.fullmatch(r'(?:[a-z]{3}, )?(\d{1,2})[ -]([a-z]{3})[ -](\d{4})(?: (\d{1,2}):(\d\d)(?::(\d\d))?)?(?: (am|pm))?\s*(.*)',s)
            if m: d,mo,y,h,mi,se,ap,z=m.groups()
            else:
                m=re.fullmatch(r'([a-z]+) (\d{1,2}), (\d{4}) (\d\d):(\d\d)()',s)
                if m: mo,d,y,h,mi,se=m.groups()
                else:
                    m=re.fullmatch(r'(\d\d)[/.](\d\d)[/.](\d{4})(?: (\d\d):(\d\d)(?::(\d\d))?)?\s*(.*)',s)
                    if m: d,mo,y,h,mi,se,z=m.groups()
                    else:
                        m=re.fullmatch(r'(\d{1,2})([a-z]{3})(\d{4})(\d\d)(\d\d)(\d\d)(gmt)',s)
                        if m: d,mo,y,h,mi,se,z=m.groups()
                        else: return None
    try:
        mo=M[mo[:3]] if not mo.isdigit() else int(mo)
        h=int(h or 0)
        if ap: h=h%12+(12 if ap=='pm' else 0)
        t=D.datetime(int(y),mo,int(d),h,int(mi or 0),int(se or 0),int((f or '').ljust(6,'0')[:6] or 0))
    except (ValueError,KeyError): return None
    ep=lambda x:(x-D.datetime(1970,1,1,tzinfo=D.timezone.utc))//D.timedelta(microseconds=1)
    if z:
        if z in AB: off=AB[z]
        else:
            m=re.fullmatch(r'(?:utc)?([+-])(\d{1,2}):?(\d\d)',z)
            if not m: return None
            off=(int(m[2])*60+int(m[3]))*(-1 if m[1]=='-' else 1)
        return ep(t.replace(tzinfo=D.timezone(D.timedelta(minutes=off))))
    zi=ZoneInfo(hint or 'Asia/Colombo')
    c=set()
    for fold in (0,1):
        u=t.replace(tzinfo=zi,fold=fold).astimezone(D.timezone.utc)
        if u.astimezone(zi).replace(tzinfo=None)==t: c.add(ep(u))
    return c.pop() if len(c)==1 else None


def test_instants_row_by_row(spark):
    want = set()
    for r in spark.read.parquet(f"{DATA}/feed_items.parquet").collect():
        for name in ("uploaded_date", "manual_date", "authorized_date"):
            text = r[name]
            u = _parse(text, None)
            if u is not None and not (name == "manual_date" and (u == -19_800_000_000 or text.strip() in ("-19800000", "-19800000.0"))):
                want.add(("feed_items", r["feed_row_no"], name, u))
    for r in spark.read.parquet(f"{DATA}/source_instants.parquet").collect():
        u = _parse(r["raw"], r["zone_hint"])
        if u is not None:
            want.add(("source_instants", r["instant_id"], "raw", u))
    got = {(r["table_name"], r["row_no"], r["field_name"], r["utc_us"]) for r in problems.p6_found(spark, DATA).collect()}
    assert got == want and len(got) > 150


def test_amounts_row_by_row(spark):
    """Numbers and units by plain string handling, for the rows whose amount is digits with commas and a point."""
    rows = {r["value_id"]: r for r in spark.read.parquet(f"{DATA}/reported_values.parquet").collect()}
    got = {r["value_id"]: (r["currency_code"], r["amount_e4"]) for r in problems.p4_found(spark, DATA).collect()}
    n = 0
    for k, r in rows.items():
        if r["raw_value"] and re.fullmatch(r"\(?\d{1,3}(,\d{3})*(\.\d{1,2})?\)?", r["raw_value"]) and r["reported_scale"] and r["currency"] == "LKR" and r["value_type"] == "currency_amount" and re.fullmatch(r"[A-Za-z ]+", r["label_raw"]):
            digits = r["raw_value"].strip("()").replace(",", "")
            whole, _, part = digits.partition(".")
            amount = (int(whole) * 100 + int(part.ljust(2, "0") or 0)) * 100 * r["reported_scale"]
            assert got[k] == ("LKR", -amount if r["raw_value"][0] == "(" else amount)
            n += 1
        if r["representation_class"] in ("percentage", "dash_nil", "not_a_number"):
            assert k not in got
    assert n > 50


def test_scales_of_heading_texts_are_those_that_their_words_state(spark):
    got = {r["source"].removeprefix("heading:"): r["log10_scale"] for r in problems.p4_source_scales(spark, DATA).where("hops > 0").collect()}
    assert len(got) > 5
    assert {t: round(10 ** (k + 4)) for t, k in got.items()} == {t: money.stated_by_headings(t)[0] for t in got}
